"""Accruals kept by run, two-way comparison, purges, reject layouts and strict repairs on small rows."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from conftest import spark_rows
from pyspark.sql import functions as F

from pensio import schemas
from pensio.functions.semantics import add_months_keeping_end
from pensio.plans import reconcile, registry, repair, run
from pensio.sources.runs import RunTable

D = dt.date


def files(root) -> dict[str, float]:
    return {
        os.path.join(folder, f): os.path.getmtime(os.path.join(folder, f))
        for folder, _, names in os.walk(root)
        for f in names
        if f.endswith(".parquet")
    }


def accruals(table, *rows):
    return table("assignments", *[dict(id=i, fk_doc_with_action=r, paydate=D(2018, 1, 1), amount=Decimal(a)) for i, r, a in rows])


@pytest.fixture
def held(spark, table, tmp_path):
    kept = RunTable(spark, str(tmp_path / "assignments"), schemas.schema("assignments"))
    kept.replace(accruals(table, (1, 10, "1.00"), (2, 10, "2.00"), (3, 20, "3.00"), (4, 30, "4.00")))
    return kept


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_replacing_a_run_leaves_the_files_of_the_others(held, table):
    before = files(held.path)
    held.replace(accruals(table, (7, 20, "9.00"), (8, 40, "9.00")))
    after = files(held.path)
    assert ids(held.read()) == [1, 2, 4, 7, 8]
    for run_no in (10, 30):
        own = {f: t for f, t in before.items() if f"fk_doc_with_action={run_no}/" in f}
        assert own and own == {f: t for f, t in after.items() if f"fk_doc_with_action={run_no}/" in f}
    assert held.read().schema.names == schemas.schema("assignments").names


def test_deleting_a_run_reads_and_writes_nothing_else(held, table):
    before = files(held.path)
    orders = table(
        "pay_orders",
        dict(fk_document=20, operation_date=D(2018, 2, 10), fk_pay_order_type=5),
        dict(fk_document=30, operation_date=D(2018, 2, 10), fk_pay_order_type=4),
        dict(fk_document=30, operation_date=D(2018, 3, 10), fk_pay_order_type=5),
        dict(fk_document=31, operation_date=D(2018, 3, 10), fk_pay_order_type=5),
    )
    assert run.delete_run_folder(held, orders, D(2018, 2, 10)) == 20
    assert run.delete_run_folder(held, orders, D(2018, 2, 10)) == 20  # again: nothing to delete, no error
    assert run.delete_run_folder(held, orders, D(2018, 5, 10)) is None
    with pytest.raises(ValueError):
        run.delete_run_folder(held, orders, D(2018, 3, 10))
    assert ids(held.read()) == [1, 2, 4]
    assert files(held.path) == {f: t for f, t in before.items() if "fk_doc_with_action=20/" not in f}
    assert {r[0] for r in held.runs().collect()} == {10, 30}


def test_one_run_is_read_from_its_folder(held, table):
    orders = table("pay_orders", dict(fk_document=10, operation_date=D(2018, 2, 10), fk_pay_order_type=5))
    chosen = run.snapshot_run(held.read(), orders, D(2018, 2, 10))
    assert ids(chosen) == [1, 2]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fk_doc_with_action" in plan
    found = chosen.select(F.input_file_name().alias("f")).distinct().collect()
    assert found and all("fk_doc_with_action=10/" in r.f for r in found)


def test_runs_differ_both_ways_and_in_number(table):
    def rows(*what):
        return table("assignments", *[
            dict(fk_doc_with_acct=a, paydate=D(2018, 1, 1), amount=Decimal(m), fk_asgmt_type=t) for a, m, t in what
        ])

    old = rows((1, "5.00", 2), (1, "5.00", 2), (2, "7.00", 2), (3, "8.00", 2), (None, "1.00", 2), (4, "9.00", 1))
    new = rows((1, "5.00", 2), (2, "7.00", 2), (3, "8.01", 2), (5, "2.00", 2), (None, "1.00", 2), (6, "1.00", 1))
    got = reconcile.reconcile_two_way(old, new)
    assert {(r.fk_doc_with_acct, str(r.amount), r.cnt_reference, r.cnt_new) for r in got.collect()} == {
        (1, "5.00", 2, 1), (3, "8.00", 1, 0), (3, "8.01", 0, 1), (5, "2.00", 0, 1),
    }
    assert got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange ") == 1
    assert reconcile.reconcile_two_way(old, old).isEmpty()


def test_purge_tells_what_went(table, tmp_path):
    tables = {
        "debt_withholdings": table("debt_withholdings", dict(fk_debt_assignment=1), dict(fk_debt_assignment=2)),
        "assignments": table("assignments", dict(id=1)),
        "pay_orders": table("pay_orders"),
    }
    got = run.purge(tables, str(tmp_path)).orderBy("step").collect()
    assert [tuple(r) for r in got] == [(1, "debt_withholdings", 2, 0), (2, "assignments", 1, 0), (3, "pay_orders", 0, 0)]


def test_strict_backfill_needs_the_contract_itself_to_match(table):
    day, pay = D(2001, 1, 1), Decimal("10.00")
    dogs = table(
        "sp_pen_dog",
        dict(ssylka=1, data_nach_vypl=day, razm_pen=pay, nom_dog="hit"),
        dict(ssylka=1, data_nach_vypl=D(2002, 1, 1), razm_pen=pay, nom_dog="other"),
        dict(ssylka=1, data_nach_vypl=day, razm_pen=pay, ref_kodinsz=5, nom_dog="linked"),
        dict(ssylka=1, data_nach_vypl=day, nom_dog="no amount"),
    )
    given = (
        table("pension_agreements", *[dict(fk_contract=k, fk_base_contract=9, effective_date=day, amount=pay) for k in (70, 71)]),
        table("contracts", dict(fk_document=9)),
        table("transform_contragents", dict(fk_contract=9, ssylka_fl=1)),
    )
    strict = repair.backfill_contract_ref(dogs, *given, strict=True)
    assert {r.nom_dog: r.ref_kodinsz for r in strict.collect()} == {"hit": 71, "other": None, "linked": 5, "no amount": None}
    loose = repair.backfill_contract_ref(dogs, *given)
    assert {r.ref_kodinsz for r in loose.collect()} == {71}


def test_month_ends_stay_month_ends(spark):
    days = [(D(2019, 2, 28), 1, D(2019, 3, 31)), (D(2020, 1, 31), 1, D(2020, 2, 29)), (D(2020, 2, 28), 12, D(2021, 2, 28)),
            (D(2019, 3, 30), -1, D(2019, 2, 28)), (D(2020, 2, 29), -12, D(2019, 2, 28)), (None, 1, None)]
    df = spark.createDataFrame(days, "d date, n int, want date")
    assert all(r.got == r.want for r in df.withColumn("got", add_months_keeping_end("d", F.col("n"))).collect())


def test_balances_are_expanded_for_the_participants_asked_for(spark, table):
    dogs = table("sp_pen_dog", *[dict(ssylka=s, nom_vkl=9, nom_ips=s, shema_dog=2, ref_kodinsz=k) for s, k in ((1, 1), (1, 2), (2, 3))])
    ips = table("sp_ips", *[dict(ssylka_fl=s, nom_vkl=9, nom_ips=s, tip_lits=1) for s in (1, 2)])
    moves = table("dv_sr_ips", *[dict(nom_vkl=9, nom_ips=s, summa=Decimal(s), shifr_schet=0, sub_shifr_schet=0) for s in (1, 1, 1, 2)])
    signs = table("kod_shifr_schet", dict(shifr_schet=0, sub_shifr_schet=0, ips=-1))
    parts = registry.factored_balances(dogs, ips, moves, signs)
    assert {tuple(r) for r in parts.sizes().collect()} == {(1, 3, 2, 6), (2, 1, 1, 1)}
    assert parts.movements.count() == 4 and parts.contracts.count() == 3
    assert spark_rows(parts.of()) == spark_rows(registry.ips_balances(dogs, ips, moves, signs))
    only = parts.of(spark.createDataFrame([(2,), (2,)], "id long")).collect()
    assert [(r.ssylka, str(r.amount)) for r in only] == [(2, "-2.00")]
