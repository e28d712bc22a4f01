"""Target-side views: accounts, addenda, pay order periods, pension agreements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pensio.functions.semantics import (
    NO_NEXT_ADDENDUM,
    OPEN_END,
    cents,
    day,
    days_in_month,
    divide_half_up,
    from_cents,
    month_start,
    quarter_start,
    strict_greatest,
    strict_least,
    year_start,
)
from pensio.operators.ordering import windowed

# Fixed values.
PENSION_ACCOUNT_TYPE = 4
AGREEMENT_CONTRACT_TYPE = 6
AGREEMENT_SCHEMES = (1, 2, 3, 4, 5, 6, 8)
STATE_ACTIVE, STATE_DEACTIVATED = 1, 2
NOT_ARCHIVED = 0


def accounts_sspv(accounts: DataFrame) -> DataFrame:
    """Accounts pensions are paid from."""
    return accounts.where(F.col("fk_acct_type") == PENSION_ACCOUNT_TYPE).select(
        "fk_scheme", "id", "acct_number", "title"
    )


# Serial numbers of an agreement that one task numbers.
SERIALS = 1000


def addendum_segments(addendums: DataFrame) -> DataFrame:
    """Valid addenda as segments that end the day before the agreement's next addendum by serial number."""
    active = addendums.where(F.col("canceled") == 0).withColumn(
        "from_month", month_start("alt_date_begin")
    )
    placed = windowed(
        active,
        ["fk_pension_agreement"],
        ["serialno", "id"],
        bucket=[F.floor(F.col("serialno") / SERIALS)],
        lead={"_next": "alt_date_begin"},
        lag={"amount_prev": "amount"},
    )
    placed = windowed(
        placed,
        ["fk_pension_agreement", "from_month"],
        ["serialno", "id"],
        bucket=[F.floor(F.col("serialno") / SERIALS)],
        rn="month_serialno",
    )
    return placed.select(
        "id",
        "from_month",
        F.col("alt_date_begin").alias("from_date"),
        F.coalesce(F.date_sub("_next", 1), day(NO_NEXT_ADDENDUM)).alias("end_date"),
        "fk_pension_agreement",
        "fk_provacct",
        "serialno",
        "month_serialno",
        "amount_prev",
        "amount",
        "alt_date_begin",
        "alt_date_end",
        F.last_day("alt_date_begin").alias("last_day_from_month"),
    )


def addendum_months(segments: DataFrame) -> DataFrame:
    """One row per agreement and start month, with the first month's amount prorated by days.

    All rows of a group share the month length, so the prorated sum is one exact division of whole cents, rounded
    half away from zero. The source divides row by row first, which can differ on exact half-cent ties only.
    A row without amount adds nothing, not even the days carried in from the previous addendum.
    """
    begin, month_end = F.col("alt_date_begin"), F.col("last_day_from_month")
    carried_in = F.when(
        (F.col("month_serialno") == 1)
        & (F.col("from_month") != begin)
        & F.col("amount_prev").isNotNull(),
        cents("amount_prev") * F.datediff(begin, "from_month"),
    ).otherwise(0)
    own = cents("amount") * (F.datediff(strict_least(F.col("end_date"), month_end), begin) + 1)
    month_aligned_end = F.when(
        F.col("end_date") != F.last_day("end_date"), F.date_sub(month_start("end_date"), 1)
    ).otherwise(F.col("end_date"))
    grouped = segments.groupBy("fk_pension_agreement", "from_month").agg(
        F.max(strict_greatest(month_aligned_end, month_end)).alias("end_date"),
        F.sum(carried_in + own).alias("_cent_days"),
        F.max("amount").alias("amount"),
        F.max(F.struct("month_serialno", "fk_provacct")).alias("_last"),
    )
    return grouped.select(
        "fk_pension_agreement",
        F.col("from_month").alias("from_date"),
        "end_date",
        from_cents(divide_half_up(F.col("_cent_days"), days_in_month("from_month"))).alias("first_amount"),
        "amount",
        F.col("_last.fk_provacct").alias("fk_provacct"),
    )


def pay_order_periods(pay_orders: DataFrame) -> DataFrame:
    """Calendar periods around the payment period of each pay order."""
    period = F.col("payment_period")
    year, second_half = year_start(period), F.month(period) > 6
    return pay_orders.select(
        "fk_document",
        "payment_period",
        "operation_date",
        "payment_freqmask",
        "scheduled_date",
        "calculation_date",
        "fk_pay_order_type",
        "export_err_count",
        month_start(period).alias("start_month"),
        F.last_day(period).alias("end_month"),
        quarter_start(period).alias("start_quarter"),
        F.date_sub(F.add_months(quarter_start(period), 3), 1).alias("end_quarter"),
        F.when(second_half, F.add_months(year, 6)).otherwise(year).alias("start_halfyear"),
        F.date_sub(F.add_months(year, F.when(second_half, 12).otherwise(6)), 1).alias("end_half_year"),
        year.alias("start_year"),
        F.make_date(F.year(period), F.lit(12), F.lit(31)).alias("end_year"),
        F.make_date(F.year(period), F.lit(12), F.lit(1)).alias("end_year_month"),
    )


def pension_agreements(agreements: DataFrame, contracts: DataFrame) -> DataFrame:
    """Agreements with their own contract and their base contract."""
    in_scheme = contracts.where(F.col("fk_scheme").isin(*AGREEMENT_SCHEMES))
    own = in_scheme.where(F.col("fk_cntr_type") == AGREEMENT_CONTRACT_TYPE).select(
        F.col("fk_document").alias("fk_contract"), "cntr_number", F.col("fk_account").alias("fk_credit"),
        "fk_company", "fk_scheme", "fk_contragent",
    )
    base = in_scheme.select(
        F.col("fk_document").alias("fk_base_contract"), F.col("fk_account").alias("fk_debit"),
        F.col("fk_cntr_type").alias("fk_base_cntr_type"), F.col("fk_scheme").alias("fk_base_scheme"),
    )
    return agreements.join(own, "fk_contract").join(base, "fk_base_contract").select(
        "fk_base_contract", "fk_contract", "cntr_number", "state", "period_code", "isarhv", "fk_debit",
        "fk_credit", "fk_pay_detail", "fk_company", "fk_scheme", "fk_contragent", "effective_date",
        "expiration_date", F.col("amount").alias("pa_amount"),
        F.coalesce("expiration_date", day(OPEN_END)).alias("last_pay_date"), "creation_date", "last_update",
        "fk_base_cntr_type", "fk_base_scheme", "date_pension_age",
    )


def is_active():
    return (F.col("state") == STATE_ACTIVE) & (F.col("isarhv") == NOT_ARCHIVED)


def agreements_active(agreements_v: DataFrame) -> DataFrame:
    """Active, unarchived agreements."""
    return agreements_v.where(is_active()).select(
        "fk_contract", "fk_base_contract", "state", "period_code", "fk_debit", "fk_credit", "fk_company",
        "fk_scheme", "fk_contragent", "effective_date", "expiration_date", "pa_amount", "last_pay_date",
        "creation_date", "date_pension_age",
    )


def agreements_import(agreements_v: DataFrame) -> DataFrame:
    """Agreements with the next effective date, ordinal and count inside their base contract.

    Equal effective dates are ordered by contract, which the source leaves open.
    """
    numbered = windowed(
        agreements_v,
        ["fk_base_contract"],
        ["effective_date", "fk_contract"],
        bucket=[F.year("effective_date")],
        rn="rn",
        cnt="cnt",
        lead={"effective_date_next": "effective_date"},
    )
    return numbered.select(
        "fk_base_contract", "fk_contract", "cntr_number", "state", "isarhv", "fk_debit", "fk_credit",
        "fk_pay_detail", "fk_company", "fk_scheme", "fk_contragent", "effective_date", "expiration_date",
        "pa_amount", "last_pay_date", "creation_date", "last_update", "effective_date_next", "rn", "cnt",
    )


def agreement_periods(periods: DataFrame, active: DataFrame) -> DataFrame:
    """Calculation window of each active agreement."""
    window = periods.select(
        F.col("fk_pension_agreement"), "calc_date", "check_date", "pa_effective_date", "is_disabled_pa"
    )
    return window.join(active, window["fk_pension_agreement"] == active["fk_contract"]).select(
        "fk_pension_agreement", "calc_date", "check_date", "pa_effective_date", "is_disabled_pa",
        "fk_base_contract", "state", "period_code", "fk_debit", "fk_credit", "fk_company", "fk_scheme",
        "fk_contragent", "effective_date", "expiration_date", "pa_amount", "last_pay_date", "creation_date",
        "date_pension_age",
    )
