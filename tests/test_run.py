"""Preparing a run on the mapped tables, step by step and as a whole."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import DATA, spark_rows
from pyspark.sql import functions as F

from pensio.demo.catalog import DATE_OP, Plans
from pensio.plans import agreements as agreements_plans
from pensio.plans import repair, run

D = dt.date


@pytest.fixture(scope="module")
def plans(spark):
    return Plans(spark, DATA)


def test_two_orders_for_one_date_fail(spark, plans):
    doubled = plans.pay_orders.unionByName(plans.pay_orders.withColumn("fk_document", F.col("fk_document") + 1))
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        run.snapshot_run(plans.assignments, doubled, DATE_OP).count()


def test_no_order_for_a_date(plans):
    assert run.snapshot_run(plans.assignments, plans.pay_orders, D(1990, 1, 1)).count() == 0
    assert run.delete_run(plans.assignments, plans.pay_orders, D(1990, 1, 1)).count() == plans.assignments.count()


def test_snapshot_and_rest_make_the_whole(plans):
    parts = [f(plans.assignments, plans.pay_orders, DATE_OP) for f in (run.snapshot_run, run.delete_run)]
    assert spark_rows(parts[0]) + spark_rows(parts[1]) == spark_rows(plans.assignments)


def test_prepared_run(plans, tmp_path):
    got = run.prepare_run(
        DATE_OP,
        str(tmp_path),
        assignments=plans.assignments,
        pay_orders=plans.pay_orders,
        payments=plans.v_payments,
        transform_contragents=plans.transform_contragents,
        agreements=plans.pension_agreements,
        agreements_v=plans.v_agreements,
        contracts=plans.contracts,
        pay_restrictions=plans.pay_restrictions,
        addendums=plans.pension_agreement_addendums,
    )
    paid = {r[0] for r in got.participants.select("fk_contract").collect()}
    assert paid
    before = {r["fk_contract"]: (r["state"], r["isarhv"]) for r in plans.pension_agreements.collect()}
    after = {r["fk_contract"]: (r["state"], r["isarhv"]) for r in got.agreements.collect()}
    listed = {r["fk_contract"] for r in plans.v_agreements.collect()}
    active = {k for k in listed if before[k] == (1, 0)}
    for k in before:
        want = (1, 0) if k in paid else (2, before[k][1]) if k in active else before[k]
        assert after[k] == want, k
    assert got.agreements.count() == len(before)
    assert got.reference_assignments.count() + got.assignments.count() == plans.assignments.count()
    since = DATE_OP - dt.timedelta(days=run.DAYS_BEFORE_OPERATION)
    recent = got.addendums.where((F.col("creation_date") > F.lit(since)) & (F.col("serialno") > 0))
    assert {r["canceled"] for r in recent.collect() if r["fk_pension_agreement"] in paid} == {1}
    assert got.restrictions.count() == plans.pay_restrictions.count()
    assert {(r["state"], r["isarhv"]) for r in got.without_addenda.collect()} <= {(1, 0)}


def test_control_sees_the_states_after_the_updates(table):
    """A paid agreement that was inactive and has no addendum is listed as active."""
    agreements = table("pension_agreements", dict(fk_contract=1, fk_base_contract=2, state=2, isarhv=1))
    contracts = table(
        "contracts",
        dict(fk_document=1, fk_scheme=1, fk_cntr_type=6),
        dict(fk_document=2, fk_scheme=1, fk_cntr_type=1),
    )
    before = agreements_plans.pension_agreements(agreements, contracts)
    paid = before.select("fk_contract")
    after = agreements_plans.pension_agreements(run.update_states(agreements, before, paid), contracts)
    listed = run.agreements_without_addenda(paid, after, table("pension_agreement_addendums"))
    assert [(r["fk_contract"], r["state"], r["isarhv"]) for r in listed.collect()] == [(1, 1, 0)]


def test_capture_clears_filters_and_takes_the_result(table, spark):
    orders = spark.createDataFrame([(5,), (6,), (5,)], "fk_document long")
    filters = table("pay_order_filters", dict(id=1, fk_pay_order=5), dict(id=2, fk_pay_order=7))
    accruals = table("assignments", dict(id=1, fk_doc_with_action=6), dict(id=2, fk_doc_with_action=8), dict(id=3))
    left, result = run.capture_run(accruals, filters, orders)
    assert [r["id"] for r in left.collect()] == [2] and [r["id"] for r in result.collect()] == [1]


def test_purge_empties_children_first(plans):
    tables = {n: getattr(plans, n) for n in ("pay_orders", "assignments", "debt_withholdings")}
    purged = run.purge_runs(tables)
    assert list(purged) == ["debt_withholdings", "assignments", "pay_orders"]
    assert all(t.isEmpty() and t.schema == tables[n].schema for n, t in purged.items())


def test_scans_of_a_run(spark, plans):
    known = plans.new_order_documents[0]
    assert known._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 2


def test_pay_orders_are_kept_or_created(spark, table):
    orders = table(
        "pay_orders",
        dict(fk_document=5, operation_date=D(2018, 9, 10), fk_pay_order_type=5),
        dict(fk_document=4, operation_date=D(2018, 9, 10), fk_pay_order_type=5),
        dict(fk_document=6, operation_date=D(2018, 10, 10), fk_pay_order_type=1),
    )
    dates = spark.createDataFrame([(D(2018, 9, 10),), (D(2018, 11, 9),), (D(2018, 10, 10),), (D(2018, 11, 9),)], "d date")
    known, documents, created = run.ensure_pay_orders(orders, dates, 100)
    assert {tuple(r) for r in known.collect()} == {
        (D(2018, 9, 10), 4, False), (D(2018, 10, 10), 100, True), (D(2018, 11, 9), 101, True),
    }
    assert {(r["id"], r["doc_date"]) for r in documents.collect()} == {(100, D(2018, 10, 10)), (101, D(2018, 11, 9))}
    assert {(r["payment_period"], r["payment_freqmask"]) for r in created.collect()} == {
        (D(2018, 10, 1), "00001111"), (D(2018, 11, 1), "00001111"),
    }


def test_reopening_and_cancelling(table, spark):
    add = lambda i, serial, canceled, day, k=1: dict(
        id=i, fk_pension_agreement=k, serialno=serial, canceled=canceled, creation_date=day
    )
    old, new = D(2018, 9, 1), D(2018, 9, 9)
    addenda = table(
        "pension_agreement_addendums",
        add(0, 0, 2, old), add(1, 1, 3, old), add(2, 2, 0, new), add(3, 0, 0, new, 2), add(4, 0, 2, old, 3),
        add(5, 2, 0, new, 3),
    )
    paid = spark.createDataFrame([(1,), (1,), (2,)], "fk_contract long")
    reopened = run.reopen_addenda(addenda, paid, D(2018, 9, 10))
    assert {r["id"]: r["canceled"] for r in reopened.collect()} == {0: 0, 1: 3, 2: 0, 3: 0, 4: 2, 5: 0}
    done = run.cancel_recent_addenda(reopened, paid, D(2018, 9, 10))
    assert {r["id"]: r["canceled"] for r in done.collect()} == {0: 0, 1: 3, 2: 1, 3: 0, 4: 2, 5: 0}


def test_cancelled_restrictions(table, spark):
    pr = lambda i, lo, hi, c=None, k=1: dict(
        id=i, fk_doc_with_acct=k, effective_date=lo, expiration_date=hi, fk_document_cancel=c
    )
    restrictions = table(
        "pay_restrictions",
        pr(1, D(2018, 8, 1), None), pr(2, D(2018, 8, 1), D(2018, 8, 14)), pr(3, D(2018, 8, 1), D(2018, 8, 15)),
        pr(4, D(2018, 8, 16), None), pr(5, D(2018, 8, 1), None, 7), pr(6, D(2018, 8, 1), None, None, 2),
    )
    paid = spark.createDataFrame([(1, D(2018, 8, 15)), (1, D(2018, 7, 1))], "fk_contract long, data_nachisl date")
    got = run.cancel_restrictions(restrictions, paid)
    assert {r["id"]: r["fk_document_cancel"] for r in got.collect()} == {1: 0, 2: None, 3: 0, 4: None, 5: 7, 6: None}


def test_backfill_reaches_all_contracts_of_a_participant(table):
    dog = lambda start, amount, ref=None: dict(ssylka=1, data_nach_vypl=start, razm_pen=Decimal(amount), ref_kodinsz=ref, shema_dog=1)
    contracts = table("sp_pen_dog", dog(D(2000, 1, 1), 5), dog(D(2001, 1, 1), 6, 77))
    agreement = lambda k: dict(fk_contract=k, fk_base_contract=9, effective_date=D(2000, 1, 1), amount=Decimal(5))
    agreements = table("pension_agreements", agreement(30), agreement(31))
    got = repair.backfill_contract_ref(
        contracts,
        agreements,
        table("contracts", dict(fk_document=9)),
        table("transform_contragents", dict(fk_contract=9, ssylka_fl=1)),
    )
    assert [r["ref_kodinsz"] for r in got.collect()] == [31, 31]
    lost = repair.contracts_without_agreement(contracts, agreements)
    assert {r["ref_kodinsz"] for r in lost.collect()} == {None, 77}
