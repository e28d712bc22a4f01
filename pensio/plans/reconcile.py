"""Comparing the accruals of two runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from pensio.functions.semantics import asc

# Fixed value: assignments that are compared.
COMPARED_TYPE = 2


def reconcile_assignments(
    reference: DataFrame, new: DataFrame, agreement_periods: DataFrame, balances: DataFrame
) -> DataFrame:
    """All reference accruals of agreements that have an accrual the new run lacks, new values beside them.

    Accruals are compared by agreement, day and amount to the cent, one way: extra accruals of the new run do not
    count, and only the reference side is limited to the compared type.
    """
    def compared(df):
        return df.select("fk_doc_with_acct", "paydate", F.round("amount", 2).alias("amount"))

    differing = (
        compared(reference.where(F.col("fk_asgmt_type") == COMPARED_TYPE))
        .subtract(compared(new))
        .select("fk_doc_with_acct")
    )
    old = reference.select("fk_doc_with_acct", "fk_debit", "fk_asgmt_type", "paydate", "amount", "paydays")
    beside = new.select(
        "fk_doc_with_acct", "paydate", F.col("paydate").alias("new_pay_date"),
        F.col("amount").alias("new_amount"), F.col("paydays").alias("new_paydays"),
    )
    terms = agreement_periods.select(
        F.col("fk_pension_agreement").alias("fk_doc_with_acct"), F.col("fk_debit").alias("_account"),
        "calc_date", "expiration_date", "period_code", "fk_scheme", "last_pay_date", "pa_amount",
        "fk_base_contract", "fk_contragent",
    )
    balance = balances.select(F.col("fk_account").alias("_account"), F.col("amount").alias("balance_debit"))
    return (
        old.join(differing, "fk_doc_with_acct", "left_semi")
        .join(terms, "fk_doc_with_acct")
        .join(beside, ["fk_doc_with_acct", "paydate"], "left")
        .join(balance, "_account", "left")
        .select(
            "fk_doc_with_acct", "fk_debit", "fk_asgmt_type", "paydate", "amount", "paydays", "new_pay_date",
            "new_amount", "new_paydays", "balance_debit", "calc_date", "expiration_date", "period_code",
            "fk_scheme", "last_pay_date", "pa_amount", "fk_base_contract", "fk_contragent",
        )
        .orderBy(*asc("fk_doc_with_acct", "paydate", "amount", "new_amount"))
    )


def reconcile_two_way(reference: DataFrame, new: DataFrame) -> DataFrame:
    """Accruals that two runs do not hold equally often, with how often each holds them.

    Agreement, day and amount to the cent make an accrual; both sides are limited to the compared type. Each row counts
    for its side, so repeated accruals are told apart and one aggregate, with a map-side part, compares both ways.
    """
    def side(df, a, b):
        return df.where(F.col("fk_asgmt_type") == COMPARED_TYPE).select(
            "fk_doc_with_acct", "paydate", F.round("amount", 2).alias("amount"),
            F.lit(a).alias("_reference"), F.lit(b).alias("_new"),
        )

    return (
        side(reference, 1, 0)
        .unionByName(side(new, 0, 1))
        .groupBy("fk_doc_with_acct", "paydate", "amount")
        .agg(F.sum("_reference").alias("cnt_reference"), F.sum("_new").alias("cnt_new"))
        .where("cnt_reference <> cnt_new")
    )


def run_size_compare(runs: dict[str, DataFrame]) -> DataFrame:
    """Accruals and distinct agreements of each run."""
    sizes = [
        run.groupBy("fk_doc_with_acct")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.lit(label).alias("tbl"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("cnt"),
            F.count("fk_doc_with_acct").alias("cnt2"),
        )
        for label, run in runs.items()
    ]
    return reduce(DataFrame.unionByName, sizes)
