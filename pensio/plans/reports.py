"""Drill-downs for sets of participants or agreements, and progress reports.

Where a report asks for an order by a date alone, further columns follow it, so that a range-partitioned sort can
divide the rows of one date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pensio.functions.semantics import asc, desc, month_start
from pensio.plans.registry import FactoredBalances


def participant_agreement(agreements_v: DataFrame, transform_contragents: DataFrame,
                          agreements: DataFrame | None = None) -> DataFrame:
    """Agreements with their participant; ``agreements`` (fk_contract) narrows to a set."""
    chosen = agreements_v if agreements is None else of(agreements_v, "fk_contract", agreements)
    owner = transform_contragents.select(
        F.col("fk_contract").alias("fk_base_contract"), "ssylka_fl", "ssylka_ts"
    )
    return chosen.join(owner, "fk_base_contract").select(
        "fk_contract", "effective_date", "ssylka_fl", "ssylka_ts"
    )


def of(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` is among the ids in the first column of ``ids``."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(column)), column, "left_semi").select(df.columns)


def participant_dossier(
    participants: DataFrame,
    *,
    contracts: DataFrame,
    vypl_pen: DataFrame,
    balances: FactoredBalances,
    changes: DataFrame,
    restrictions: DataFrame,
    invalid: DataFrame,
) -> dict[str, DataFrame]:
    """Everything the legacy views hold about a set of participants, one DataFrame per subject."""
    return {
        "contracts": of(contracts, "ssylka", participants),
        "payments": of(vypl_pen, "ssylka_fl", participants).orderBy(
            *asc("data_op", "data_nachisl", "ssylka_fl", "ssylka_doc")
        ),
        "balances": balances.of(participants).orderBy(
            *asc("date_op", "ssylka", "ref_kodinsz")
        ),
        "changes": of(changes, "ssylka_fl", participants),
        "restrictions": of(restrictions, "ssylka_fl", participants),
        "invalid": of(invalid, "ssylka_fl", participants),
    }


def agreement_dossier(
    agreements: DataFrame,
    *,
    agreement_periods: DataFrame,
    pension_agreements: DataFrame,
    contracts: DataFrame,
    periods: DataFrame,
    pay_restrictions: DataFrame,
    addendums: DataFrame,
    balances: DataFrame,
    agreements_v: DataFrame,
    addendum_months: DataFrame,
) -> dict[str, DataFrame]:
    """Everything held about a set of agreements, one DataFrame per subject."""
    accounts = of(agreements_v, "fk_contract", agreements).select("fk_debit")
    return {
        "calculation": of(agreement_periods, "fk_pension_agreement", agreements),
        "agreement": of(pension_agreements, "fk_contract", agreements),
        "contract": of(contracts, "fk_document", agreements),
        "periods": of(periods, "fk_pension_agreement", agreements),
        "restrictions": of(pay_restrictions, "fk_doc_with_acct", agreements),
        "addenda": of(addendums, "fk_pension_agreement", agreements),
        "balance": of(balances, "fk_account", accounts),
        "addendum_months": of(addendum_months, "fk_pension_agreement", agreements),
    }


def progress_by_state(control: DataFrame) -> DataFrame:
    """Span and number of control rows per state."""
    return (
        control.groupBy("state")
        .agg(
            F.min("date_op").alias("min_date_op"),
            F.max("date_op").alias("max_date_op"),
            F.min("creation_date").alias("creation_date"),
            F.max("last_update_date").alias("last_update_date"),
            F.count(F.lit(1)).alias("cnt"),
        )
        .orderBy(*asc("state"))
    )


def progress_by_month(control: DataFrame) -> DataFrame:
    """First creation and last update per operation month, and minutes since the previous month's update.

    Months without an update are left out before the previous month is looked up.
    """
    months = (
        control.groupBy(month_start("date_op").alias("pay_month"))
        .agg(
            F.min("creation_date").alias("creation_date"),
            F.max("last_update_date").alias("last_update_date"),
        )
        .where(F.col("last_update_date").isNotNull())
    )
    # One row per calendar month: the window without a partition sees no more than that.
    previous = F.lag("last_update_date").over(Window.orderBy(*asc("pay_month")))
    seconds = F.timestamp_diff("SECOND", F.col("prev_update_date"), F.col("last_update_date"))
    return (
        months.withColumn("prev_update_date", previous)
        .withColumn("duration_min", F.round(seconds.cast("decimal(18,0)") / 60, 2).cast("decimal(18,2)"))
        .orderBy(*asc("pay_month"))
    )


def progress_listing(control: DataFrame) -> DataFrame:
    """All control rows, latest operation date first."""
    return control.orderBy(*desc("date_op"), *asc("ssylka_doc"))


def pay_order_summary(control: DataFrame, transform_po: DataFrame, assignments: DataFrame) -> DataFrame:
    """Operation dates of each imported pay order beside the number and dates of its assignments.

    Assignments are counted per pay order before they meet the control rows, of which a pay order has many.
    """
    order = transform_po.select(
        F.col("fk_document").alias("fk_pay_order"), "operation_date", "payment_period"
    )
    groups = (
        control.where(F.col("ssylka_doc").isNotNull())
        .groupBy("ssylka_doc", "fk_pay_order")
        .agg(
            F.min("date_op").alias("min_date_op"),
            F.max("date_op").alias("max_date_op"),
            F.count_distinct("date_op").alias("cnt_date_op"),
        )
        .join(order, "fk_pay_order")
    )
    return (
        groups.join(_per_order(assignments), "fk_pay_order")
        .select(
            "ssylka_doc", "fk_pay_order", "operation_date", "payment_period", "min_date_op", "max_date_op",
            "cnt_date_op", "cnt_assignments", "min_paydate", "max_paydate",
        )
        .orderBy(*asc("payment_period", "fk_pay_order", "ssylka_doc"))
    )


def _per_order(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy(F.col("fk_doc_with_action").alias("fk_pay_order")).agg(
        F.count(F.lit(1)).alias("cnt_assignments"),
        F.min("paydate").alias("min_paydate"),
        F.max("paydate").alias("max_paydate"),
    )


def run_span_summary(assignments: DataFrame, pay_orders: DataFrame) -> DataFrame:
    """Span of operation and pay dates over all assignments that have a pay order."""
    order = pay_orders.select(F.col("fk_document").alias("fk_pay_order"), "operation_date")
    return (
        _per_order(assignments)
        .join(order, "fk_pay_order")
        .agg(
            F.min("operation_date").alias("min_operation_date"),
            F.max("operation_date").alias("max_operation_date"),
            F.min("min_paydate").alias("min_paydate"),
            F.max("max_paydate").alias("max_paydate"),
            F.coalesce(F.sum("cnt_assignments"), F.lit(0)).alias("cnt"),
        )
    )
