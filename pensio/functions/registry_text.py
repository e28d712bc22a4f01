"""Reading operation date and payment period out of registry document texts (Russian)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Month names as they are written in the registry, January first.
MONTH_NAMES = (
    "январь", "февраль", "март", "апрель", "май", "июнь",
    "июль", "август", "сентябрь", "октябрь", "ноябрь", "декабрь",
)
# Month of documents whose text names none (document id -> month number).
MONTH_OF_DOCUMENT = {531: 1, 414: 12, 359: 11, 313: 10, 173: 9, 164: 7, 103: 8}
# Year of documents whose text names none.
YEAR_OF_DOCUMENT = {531: 1997}
YEAR_WITHOUT_TEXT = 1996
# Documents that belong to the first half-month whatever their day.
FIRST_HALF_DOCUMENTS = (47, 164)
# Closing documents that are no pay orders, and pay orders that are no closing documents.
NOT_PAY_ORDERS = (48, 52, 71, 75)
EXCEPTION_PAY_ORDERS = (13906, 38132, 245849, 325969)


def _lookup(key: Column, table: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def is_payment_closing(content: Column) -> Column:
    return content.like("Закрыть%ИПС%") & content.like("%выпл%пенс%")


def operation_day(content: Column, document_date: Column) -> Column:
    first = content.like("%первая%") | content.like("%перв.пол%")
    second = content.like("%вторая%") | content.like("%втор.пол%")
    return (
        F.when(first, 10)
        .when(second, 25)
        .otherwise(F.coalesce(F.dayofmonth(document_date), F.lit(1)))
    )


def operation_month(content: Column, document_id: Column, document_date: Column) -> Column:
    """The leftmost month name counts. A document without any month fails the query, as it does at the source."""
    named = F.regexp_substr(content, F.lit("|".join(MONTH_NAMES)))
    return F.coalesce(
        _lookup(named, {name: month for month, name in enumerate(MONTH_NAMES, start=1)}),
        _lookup(document_id.cast("int"), MONTH_OF_DOCUMENT),
        F.month(document_date),
        F.raise_error(F.concat(F.lit("no month in document "), document_id.cast("string"))).cast("int"),
    )


def operation_year(content: Column, document_id: Column) -> Column:
    named = F.substring(F.regexp_substr(content, F.lit(r"\D\d{4}(\D|$)")), 2, 4).cast("int")
    return F.coalesce(
        named, _lookup(document_id.cast("int"), YEAR_OF_DOCUMENT), F.lit(YEAR_WITHOUT_TEXT)
    )


def half_month(day: Column, document_id: Column) -> Column:
    return F.when((day < 15) | document_id.isin(*FIRST_HALF_DOCUMENTS), 1).otherwise(2)
