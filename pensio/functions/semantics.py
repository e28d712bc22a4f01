"""Column helpers for the NULL, date and rounding rules of the source database."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed values.
OPEN_START = "0001-01-01"  # "since ever"
OPEN_END = "9999-12-31"  # "until further notice"
NO_NEXT_ADDENDUM = "4713-01-01"  # end of the last addendum of an agreement
MONEY = "decimal(18,2)"


def day(iso: str) -> Column:
    return F.lit(iso).cast("date")


def strict_greatest(*cols: Column) -> Column:
    """Largest value, NULL as soon as one argument is NULL (Spark's own ``greatest`` skips NULLs)."""
    return F.when(_all_present(cols), F.greatest(*cols))


def strict_least(*cols: Column) -> Column:
    """Smallest value, NULL as soon as one argument is NULL."""
    return F.when(_all_present(cols), F.least(*cols))


def _all_present(cols) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def month_start(c) -> Column:
    return F.trunc(c, "MM")


def quarter_start(c) -> Column:
    return F.trunc(c, "QUARTER")  # 'Q' would silently give NULL


def year_start(c) -> Column:
    return F.trunc(c, "YEAR")  # 'Y' would silently give NULL


def days_in_month(c) -> Column:
    return F.dayofmonth(F.last_day(c))


def text(*parts: Column) -> Column:
    """Concatenation in which a NULL counts as an empty string."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def add_months_keeping_end(d, months) -> Column:
    """A day so many months on; the last day of a month stays the last day (Spark's own ``add_months`` keeps its number)."""
    d = F.col(d) if isinstance(d, str) else d
    moved = F.add_months(d, months)
    return F.when(d == F.last_day(d), F.last_day(moved)).otherwise(moved)


def cents(c) -> Column:
    """Whole cents of a two-place decimal amount."""
    return (F.col(c) * 100 if isinstance(c, str) else c * 100).cast("long")


def from_cents(c: Column) -> Column:
    return (c.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY)


def divide_half_up(numerator: Column, denominator: Column) -> Column:
    """Whole-number quotient rounded half away from zero, without leaving integers."""
    magnitude = F.call_function("div", F.abs(numerator) * 2 + denominator, denominator * 2)
    return F.when(numerator < 0, -magnitude).otherwise(magnitude)


def asc(*names) -> list[Column]:
    """Ascending order with NULLs last, the source database's default."""
    return [F.col(n).asc_nulls_last() if isinstance(n, str) else n.asc_nulls_last() for n in names]


def desc(*names) -> list[Column]:
    """Descending order with NULLs first, the source database's default."""
    return [F.col(n).desc_nulls_first() if isinstance(n, str) else n.desc_nulls_first() for n in names]
