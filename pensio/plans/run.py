"""Preparing an accrual run: its pay order, its snapshot, and the states it expects."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from pensio.functions.semantics import month_start
from pensio.operators.intervals import next_on_or_after
from pensio.operators.rows import delete_by_key, delete_where, multi_insert, update_where
from pensio.plans.agreements import (
    NOT_ARCHIVED,
    STATE_ACTIVE,
    STATE_DEACTIVATED,
    is_active,
    pension_agreements,
)
from pensio.sources.runs import RunTable
from pensio.sources.snapshots import publish, stage

# Fixed values.
ACCRUAL_ORDER_TYPE = 5
ACCRUAL_TITLE = "Тестовое начисление"
ACCRUAL_FREQUENCY = "00001111"
DAYS_BEFORE_OPERATION = 4  # a run is calculated that many days before the bank's operation date


def run_order(pay_orders: DataFrame, date_op: dt.date) -> DataFrame:
    return pay_orders.where(
        (F.col("operation_date") == F.lit(date_op)) & (F.col("fk_pay_order_type") == ACCRUAL_ORDER_TYPE)
    ).select("fk_document")


def snapshot_run(assignments: DataFrame, pay_orders: DataFrame, date_op: dt.date) -> DataFrame:
    """Assignments of the run of one operation date; more than one such pay order is an error."""
    return assignments.where(F.col("fk_doc_with_action") == run_order(pay_orders, date_op).scalar())


def delete_run(assignments: DataFrame, pay_orders: DataFrame, date_op: dt.date) -> DataFrame:
    """All other assignments."""
    return delete_where(
        assignments, F.col("fk_doc_with_action") == run_order(pay_orders, date_op).scalar()
    )


def delete_run_folder(table: RunTable, pay_orders: DataFrame, date_op: dt.date) -> int | None:
    """Deletes the run of one operation date from a table kept by run; the other runs are neither read nor written.

    Gives the pay order, None where there is none; more than one is an error.
    """
    found = run_order(pay_orders, date_op).limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"more than one accrual order on {date_op}")
    if not found:
        return None
    table.delete([found[0].fk_document])
    return found[0].fk_document


def ensure_pay_orders(
    pay_orders: DataFrame, dates: DataFrame, first_id: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(date -> pay order, new documents, new pay orders) for a set of operation dates.

    A date keeps its existing accrual order (the lowest, where there are several). Each other date gets a document
    and a pay order with the next free number, in date order.
    """
    wanted = dates.select(F.col(dates.columns[0]).alias("operation_date"), F.lit(None).cast("long").alias("_id"))
    held = pay_orders.where(F.col("fk_pay_order_type") == ACCRUAL_ORDER_TYPE).select(
        "operation_date", F.col("fk_document").alias("_id")
    )
    # One aggregate by date for both outcomes; it leaves at most one row per calendar day, which is what the
    # window without a partition sees.
    by_date = (
        wanted.withColumn("_wanted", F.lit(True))
        .unionByName(held.withColumn("_wanted", F.lit(False)))
        .where(F.col("operation_date").isNotNull())
        .groupBy("operation_date")
        .agg(F.min("_id").alias("_id"), F.max("_wanted").alias("_wanted"))
        .where("_wanted")
    )
    number = F.row_number().over(Window.orderBy(F.col("_id").isNotNull(), "operation_date"))
    known = stage(
        by_date.select(
            "operation_date",
            F.coalesce("_id", number + F.lit(first_id - 1).cast("long")).alias("fk_document"),
            F.col("_id").isNull().alias("is_new"),
        )
    )
    new = known.where("is_new")
    documents, orders = multi_insert(
        new,
        [
            F.col("fk_document").alias("id"),
            F.col("operation_date").alias("doc_date"),
            F.lit(ACCRUAL_TITLE).alias("title"),
            F.lit(0).alias("is_accounting_doc"),
        ],
        [
            F.col("fk_document"),
            month_start("operation_date").alias("payment_period"),
            F.col("operation_date"),
            F.lit(ACCRUAL_FREQUENCY).alias("payment_freqmask"),
            F.col("operation_date").alias("scheduled_date"),
            F.lit(ACCRUAL_ORDER_TYPE).alias("fk_pay_order_type"),
        ],
    )
    return known, documents, orders


def run_participants(
    payments: DataFrame, transform_contragents: DataFrame, agreements_v: DataFrame, date_op: dt.date
) -> DataFrame:
    """Agreements paid on an operation date, with the amount by accrual date and kind."""
    paid = payments.where((F.col("data_op") == F.lit(date_op)) & (F.col("summa") != 0)).select(
        "ssylka_fl", "data_nachisl", "data_op", "tip_vypl", "summa",
        F.col("data_nach_vypl").alias("effective_date"),
    )
    base = transform_contragents.select(F.col("fk_contract").alias("fk_base_contract"), "ssylka_fl")
    agreement = agreements_v.select("fk_contract", "fk_base_contract", "effective_date")
    return (
        paid.join(base, "ssylka_fl")
        .join(agreement, ["fk_base_contract", "effective_date"])
        .groupBy("fk_contract", "data_nachisl", "ssylka_fl", "data_op", "tip_vypl")
        .agg(F.sum("summa").alias("amount"))
    )


def capture_run(
    assignments: DataFrame, filters: DataFrame, orders: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(filters left, assignments) of runs given by their pay orders (fk_document).

    The orders' filters are cleared before a run is calculated; its result is what refers to the orders.
    """
    left = delete_by_key(filters, orders.select(F.col("fk_document").alias("fk_pay_order")), ["fk_pay_order"])
    ids = orders.select(F.col("fk_document").alias("fk_doc_with_action")).distinct()
    return left, assignments.join(ids, "fk_doc_with_action", "left_semi").select(assignments.columns)


# Fixed value: tables of a purge, each before the one it refers to.
PURGE_ORDER = ("debt_withholdings", "assignments", "pay_orders")


def purge_runs(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Empty snapshots of all runs' tables, children first: write them in this order."""
    return {name: delete_where(tables[name]) for name in PURGE_ORDER}


def purge(tables: dict[str, DataFrame], root: str) -> DataFrame:
    """Writes the empty snapshots under ``root`` and tells what went: (step, tbl, rows_removed, rows_left), one row a table.

    What is left is counted in the written snapshot, what was there in the table it replaces.
    """
    steps = []
    for step, (name, empty) in enumerate(purge_runs(tables).items(), 1):
        before = tables[name].groupBy().agg(F.count(F.lit(1)).alias("rows_before"))
        after = publish(empty, f"{root}/{name}").groupBy().agg(F.count(F.lit(1)).alias("rows_left"))
        steps.append(
            before.join(after).select(
                F.lit(step).alias("step"), F.lit(name).alias("tbl"),
                (F.col("rows_before") - F.col("rows_left")).alias("rows_removed"), "rows_left",
            )
        )
    return reduce(DataFrame.unionByName, steps)


def _minus(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("fk_contract").join(b.select("fk_contract"), "fk_contract", "left_anti")


def deactivate_agreements(agreements: DataFrame, agreements_v: DataFrame, paid: DataFrame) -> DataFrame:
    """Deactivates active agreements that were not paid."""
    unpaid = _minus(agreements_v.where(is_active()), paid)
    return update_where(agreements, {"state": F.lit(STATE_DEACTIVATED)}, keys=unpaid, on=["fk_contract"])


def activate_agreements(agreements: DataFrame, agreements_v: DataFrame, paid: DataFrame) -> DataFrame:
    """Activates paid agreements that are not active."""
    missing = _minus(paid, agreements_v.where(is_active()))
    return update_where(
        agreements,
        {"state": F.lit(STATE_ACTIVE), "isarhv": F.lit(NOT_ARCHIVED)},
        keys=missing,
        on=["fk_contract"],
    )


def update_states(agreements: DataFrame, agreements_v: DataFrame, paid: DataFrame) -> DataFrame:
    """Both updates: they concern disjoint agreements and look at the states before either."""
    return activate_agreements(deactivate_agreements(agreements, agreements_v, paid), agreements_v, paid)


def cancel_restrictions(pay_restrictions: DataFrame, paid: DataFrame) -> DataFrame:
    """Cancels uncancelled restrictions that cover an accrual date of a paid agreement.

    Such a restriction is one whose agreement's next accrual on or after its start is not past its end: one
    lookup per restriction start instead of comparing every restriction with every accrual.
    """
    open_ = pay_restrictions.where(F.col("fk_document_cancel").isNull())
    accruals = paid.select(F.col("fk_contract").alias("fk_doc_with_acct"), "data_nachisl")
    asked = open_.join(accruals, "fk_doc_with_acct", "left_semi")
    following = next_on_or_after(
        asked, accruals, key="fk_doc_with_acct", day="effective_date", mark="data_nachisl", out="_next"
    )
    covered = (
        asked.join(following, ["fk_doc_with_acct", "effective_date"])
        .where(F.col("_next") <= F.coalesce("expiration_date", "_next"))
        .select("id")
    )
    return update_where(pay_restrictions, {"fk_document_cancel": F.lit(0)}, keys=covered, on=["id"])


def _recent(addendums: DataFrame, paid: DataFrame, date_op: dt.date) -> DataFrame:
    since = date_op - dt.timedelta(days=DAYS_BEFORE_OPERATION)
    agreements = paid.select(F.col("fk_contract").alias("fk_pension_agreement"))
    return addendums.where(F.col("creation_date") > F.lit(since)).join(
        agreements, "fk_pension_agreement", "left_semi"
    )


def reopen_addenda(addendums: DataFrame, paid: DataFrame, date_op: dt.date) -> DataFrame:
    """Makes addenda valid again that were cancelled by an addendum created after the run was calculated."""
    cancelling = _recent(addendums, paid, date_op).select(
        "fk_pension_agreement", F.col("serialno").alias("canceled")
    )
    return update_where(
        addendums,
        {"canceled": F.lit(0)},
        keys=cancelling,
        on=["fk_pension_agreement", "canceled"],
        where=F.col("canceled") > 0,
    )


def cancel_recent_addenda(addendums: DataFrame, paid: DataFrame, date_op: dt.date) -> DataFrame:
    """Cancels addenda, other than an agreement's first, created after the run was calculated."""
    since = date_op - dt.timedelta(days=DAYS_BEFORE_OPERATION)
    return update_where(
        addendums,
        {"canceled": F.lit(1)},
        keys=paid.select(F.col("fk_contract").alias("fk_pension_agreement")),
        on=["fk_pension_agreement"],
        where=(F.col("creation_date") > F.lit(since)) & (F.col("serialno") > 0),
    )


def agreements_without_addenda(paid: DataFrame, agreements_v: DataFrame, addendums: DataFrame) -> DataFrame:
    """Control: paid agreements without any addendum, once per paid row, with their states after the updates."""
    bare = paid.select("fk_contract").join(
        addendums.select(F.col("fk_pension_agreement").alias("fk_contract")), "fk_contract", "left_anti"
    )
    return agreements_v.join(bare, "fk_contract").select(agreements_v.columns)


@dataclass(frozen=True)
class PreparedRun:
    """Snapshots a preparation leaves behind."""

    reference_assignments: DataFrame
    assignments: DataFrame
    participants: DataFrame
    agreements: DataFrame
    restrictions: DataFrame
    addendums: DataFrame
    without_addenda: DataFrame


def prepare_run(
    date_op: dt.date,
    root: str,
    *,
    assignments: DataFrame,
    pay_orders: DataFrame,
    payments: DataFrame,
    transform_contragents: DataFrame,
    agreements: DataFrame,
    agreements_v: DataFrame,
    contracts: DataFrame,
    pay_restrictions: DataFrame,
    addendums: DataFrame,
) -> PreparedRun:
    """The whole preparation, each changed table written as a new snapshot under ``root``.

    The participants are written first, since every later step reads them; the two agreement updates concern
    disjoint agreements and the two addendum updates apply in this order, so each table is rewritten once.
    """
    paid = publish(
        run_participants(payments, transform_contragents, agreements_v, date_op), f"{root}/participants"
    )
    states = publish(update_states(agreements, agreements_v, paid), f"{root}/pension_agreements")
    # Cancelling wins over reopening, and neither changes what the other looks at.
    changed_addendums = cancel_recent_addenda(reopen_addenda(addendums, paid, date_op), paid, date_op)
    return PreparedRun(
        publish(snapshot_run(assignments, pay_orders, date_op), f"{root}/reference_assignments"),
        publish(delete_run(assignments, pay_orders, date_op), f"{root}/assignments"),
        paid,
        states,
        publish(cancel_restrictions(pay_restrictions, paid), f"{root}/pay_restrictions"),
        publish(changed_addendums, f"{root}/pension_agreement_addendums"),
        agreements_without_addenda(paid, pension_agreements(states, contracts), addendums),
    )
