"""Validated append, constraints and row-changing statements."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pensio import schemas
from pensio.operators import constraints, rows
from pensio.operators.constraints import (
    REJECT_TABLES,
    Check,
    Digits,
    ForeignKey,
    NotNull,
    Unique,
    append_with_rejects,
    check_constraints,
    reject_schema,
    reject_table_name,
)
from pensio.session import scratch_dir
from pensio.sources.snapshots import publish
from pensio.sources.tables import empty_like, ensure_reject_table, ensure_reject_tables, read_table

D = dt.date
RULES = [NotNull("a"), Digits("a", 2), Check("b over 0", "b > 0"), Unique(("a", "c"))]


@pytest.fixture
def batch(spark):
    data = [
        (0, 1, 1, 1), (1, 1, 1, 1), (2, None, 1, 1), (3, 100, 1, 1), (4, 2, 0, 1), (5, 2, 1, 1), (6, 3, None, None),
        (7, 3, 1, None), (8, -99, 1, 1),
    ]
    return spark.createDataFrame(data, "o int, a int, b int, c int")


def test_append_keeps_every_row_once(batch):
    accepted, rejected = append_with_rejects(batch, RULES, ["o"], tag="t")
    assert {r["o"] for r in accepted.collect()} == {0, 5, 6, 8}  # 5: row 4 broke a check, so its key was free
    assert {(r["o"], r["error_number"], r["error_tag"], r["error_operation"]) for r in rejected.collect()} == {
        ("1", 1, "t", "I"), ("2", 1400, "t", "I"), ("3", 1438, "t", "I"), ("4", 2290, "t", "I"), ("7", 1, "t", "I"),
    }
    assert rejected.schema.names == reject_schema(batch.schema).names


def test_append_against_existing_rows_and_parents(spark, batch):
    target = batch.where("o = 0")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    accepted, rejected = append_with_rejects(
        batch, [*RULES, ForeignKey(("a",), parent, ("id",))], ["o"], target=target
    )
    assert {r["o"] for r in accepted.collect()} == {5}
    errors = {r["o"]: r["error_number"] for r in rejected.collect()}
    assert (errors["0"], errors["6"], errors["2"], errors["8"]) == (1, 2291, 1400, 2291)


def test_several_unique_keys_are_decided_in_order(spark):
    """Against the row-by-row definition: a row is taken if no taken row shares one of its keys."""
    rng = random.Random(3)
    some = lambda n: rng.choice([None, *range(n)])
    data = [(i, some(25), some(25)) for i in range(120)]
    taken_a, taken_b, want = set(), set(), set()
    for i, a, b in data:
        if (a is None or a not in taken_a) and (b is None or b not in taken_b):
            want.add(i)
            taken_a |= {a} - {None}
            taken_b |= {b} - {None}
    df = spark.createDataFrame(data, "o int, a int, b int")
    accepted, rejected = append_with_rejects(df, [Unique(("a",)), Unique(("b",))], ["o"])
    assert {r["o"] for r in accepted.collect()} == want
    assert rejected.count() == len(data) - len(want)


def test_defaults_ids_and_tag_over_many_rows(spark):
    """More rows than the source's buffer holds: one tag, each row once, ids consecutive in order."""
    run_time = dt.datetime(2018, 9, 1, 12)
    schema = schemas.schema("assignments")
    df = spark.range(10_500).select(
        *[(F.col("id") * 3).cast("long").alias(f.name) if f.name == "id"
          else F.when(F.col("id") % 2 == 0, Decimal("5.00")).cast(f.dataType).alias(f.name) if f.name == "amount"
          else F.when(F.col("id") % 100 > 0, F.col("id")).alias(f.name) if f.name == "fk_doc_with_acct"
          else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    )
    accepted, rejected = append_with_rejects(
        df.withColumn("fk_created", F.col("id")),
        [NotNull("fk_doc_with_acct")],
        ["fk_created"],
        defaults=schemas.defaults("assignments", run_time),
        ids="id",
        first_id=50,
        tag="accrual",
    )
    assert (accepted.count(), rejected.count()) == (10_395, 105)
    assert {r[0] for r in rejected.select("error_tag").distinct().collect()} == {"accrual"}
    assert accepted.where(F.col("id") != F.col("fk_created") / 3 + 50).isEmpty()
    got = accepted.where("fk_created = 3").first()
    assert (got["amount"], got["direction"], got["creation_date"], got["paydays"]) == (0, 1, run_time, 0)


@pytest.mark.parametrize("length", [2, 9])
def test_only_rivals_go_round(spark, monkeypatch, length):
    """The batch is written once; later copies hold the rows of the chain only."""
    sizes = []

    def counted(df):
        out = publish(df, scratch_dir(df.sparkSession))
        sizes.append(out.count())
        return out

    monkeypatch.setattr(constraints, "stage", counted)
    alone = [(i, 1000 + i, 5000 + i) for i in range(100)]
    chain = [(200 + i, 2000 + i // 2, 6000 + (i + 1) // 2) for i in range(length)]
    df = spark.createDataFrame(alone + chain, "o int, a int, b int")
    accepted, rejected = append_with_rejects(df, [Unique(("a",)), Unique(("b",))], ["o"])
    assert sorted(r["o"] for r in accepted.collect()) == [*range(100), *range(200, 200 + length, 2)]
    assert rejected.count() == length // 2
    assert [n for n in sizes if n >= 100] == [100 + length]  # before the rounds; the outcome is written apart
    assert all(n <= length for n in sizes if n < 100)


def test_declared_widths_and_defaults(spark, table):
    rows_ = table(
        "transform_pa_assignments",
        dict(date_op=D(2018, 1, 1), ssylka_doc=1, fk_pay_order=1, import_id="x" * 14),
        dict(date_op=D(2018, 1, 1), ssylka_doc=2, fk_pay_order=1, import_id="x" * 15),
        dict(date_op=D(2018, 1, 1), ssylka_doc=10**10, fk_pay_order=1, import_id="x"),
    )
    accepted, rejected = append_with_rejects(
        rows_, schemas.rules("transform_pa_assignments"), ["ssylka_doc"],
        defaults=schemas.defaults("transform_pa_assignments", dt.datetime(2018, 1, 1)),
    )
    assert [(r["ssylka_doc"], r["state"]) for r in accepted.collect()] == [(1, "N")]
    assert sorted(r["error_number"] for r in rejected.collect()) == [1438, 12899]
    for name, key in (("accounts_balance", "fk_account"), ("pay_order_filters", "id"),
                      ("pension_agreement_periods", "fk_pension_agreement")):
        found = check_constraints(table(name, {}), schemas.rules(name), [key])
        assert f"{key} is null" in {r["rule"] for r in found.collect()}


def test_violations_of_a_table(spark, batch):
    found = check_constraints(batch, RULES, ["o"])
    assert sorted((r["rule"], r["o"]) for r in found.collect()) == [
        ("a has more than 2 digits", 3),
        ("a is null", 2),
        ("b over 0", 4),
        ("unique (a, c)", 0), ("unique (a, c)", 1), ("unique (a, c)", 4), ("unique (a, c)", 5),
        ("unique (a, c)", 6), ("unique (a, c)", 7),
    ]


def test_wholly_null_keys_do_not_collide(spark):
    df = spark.createDataFrame([(0, None, None), (1, None, None)], "o int, a int, c int")
    accepted, _ = append_with_rejects(df, [Unique(("a", "c"))], ["o"])
    assert accepted.count() == 2


def test_declared_rules(spark, table):
    orders = table("pay_orders", dict(fk_document=1))
    filters = table(
        "pay_order_filters",
        dict(id=1, fk_pay_order=1, filter_code="COMPANY"),
        dict(id=2, fk_pay_order=1),
        dict(id=3, fk_pay_order=9, filter_code="X"),
        dict(id=4, filter_code="CONTRACT"),
    )
    _, rejected = append_with_rejects(
        filters, schemas.rules("pay_order_filters", {"pay_orders": orders}), ["id"]
    )
    assert {(r["id"], r["error_number"]) for r in rejected.collect()} == {("3", 2290), ("4", 1400)}
    for name in schemas.table_names():
        schemas.rules(name)


def test_reject_tables(spark, tmp_path):
    assert reject_table_name("pay_orders") == "ERR$_PAY_ORDERS"
    for name, reject in REJECT_TABLES:
        if name.lower() in schemas.table_names():
            schema = schemas.schema(name.lower())
            path = ensure_reject_table(spark, str(tmp_path), name, schema, reject)
    df = spark.createDataFrame([(1, "m", "I", "t", *["1"] * len(schema))], reject_schema(schema))
    df.write.mode("append").parquet(path)
    ensure_reject_table(spark, str(tmp_path), name, schema, reject)  # an existing one is kept
    assert spark.read.parquet(path).count() == 1


def test_all_reject_tables(spark, tmp_path):
    paths = ensure_reject_tables(spark, str(tmp_path), {"pay_decisions": schemas.schema("debt_withholdings")})
    assert len(set(paths)) == len(REJECT_TABLES) == 12
    columns = {p.rsplit("/", 1)[1]: spark.read.parquet(p).columns for p in paths}
    assert columns["ERR$_IMP_PAY_DECISIONS"][-1] == "fk_debt_assignment"
    assert columns["ERR$_IMP_PAY_PORTFOLIOS"] == ["error_number", "error_message", "error_operation", "error_tag"]
    assert columns["ERR$_IMP_ASSIGNMENTS"] == columns["ERR$_ASSIGNMENTS"]


def test_update_and_delete_keep_unknown_rows(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 3), (None, 4)], "k int, v int")
    keys = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    got = rows.update_where(df, {"v": F.lit(9)}, keys=keys, on=["k"], where=F.col("v") > 0)
    assert {tuple(r) for r in got.collect()} == {(1, 9), (2, None), (3, 3), (None, 4)}
    assert rows.delete_where(df, F.col("v") > 2).count() == 2
    assert rows.delete_by_key(df, keys, ["k"]).count() == 2
    emptied = rows.delete_where(df)
    assert emptied.count() == 0 and emptied.schema == df.schema


def test_merge_inserts_only_what_is_missing(spark, table):
    target = table("pay_order_filters", dict(id=1, fk_pay_order=1, filter_code="CONTRACT", filter_value=5))
    source = spark.createDataFrame(
        [(1, "CONTRACT", 5), (1, "CONTRACT", 6), (1, "CONTRACT", None)], "fk_pay_order long, filter_code string, filter_value long"
    )
    got = rows.merge_insert_only(target, source, ["fk_pay_order", "filter_code", "filter_value"], "id", 10)
    assert {(r["id"], r["filter_value"]) for r in got.collect()} == {(1, 5), (10, 6), (11, None)}


def test_corrections(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 2, 2), (3, 3, 3)], "k int, a int, b int")
    new = spark.createDataFrame([(1, 9, None, True), (2, None, None, False)], "k int, a int, b int, set_b boolean")
    got = rows.apply_corrections(df, new, "k", ["a", "b"])
    assert {tuple(r) for r in got.collect()} == {(1, 9, None), (2, 2, 2), (3, 3, 3)}


def test_tables_round_trip(spark, table, tmp_path):
    df = table("accounts_balance", dict(fk_account=1, amount=Decimal("1.50"), update_date=D(2018, 9, 1)))
    publish(df, f"{tmp_path}/accounts_balance")
    assert read_table(spark, str(tmp_path), "accounts_balance").collect() == df.collect()
    publish(empty_like(spark, df.schema), f"{tmp_path}/accounts_balance")
    assert read_table(spark, str(tmp_path), "accounts_balance").count() == 0


def test_a_batch_is_judged_and_written_once(spark, tmp_path, monkeypatch):
    """One write with both outcomes, counted by its own job; what is read afterwards is that write, not the batch."""
    spark.range(1000).selectExpr("id as o", "cast(id % 7 as int) as a").write.parquet(str(tmp_path / "in"))
    given = spark.read.parquet(str(tmp_path / "in"))
    writes = []
    monkeypatch.setattr(constraints, "publish", lambda df, *a: writes.append(df) or publish(df, *a))
    monkeypatch.setattr(constraints, "stage", lambda df: writes.append(df) or publish(df, scratch_dir(spark)))
    done = constraints.append(given, [Check("a under 6", "a < 6")], ["o"], ids="id", first_id=10)
    assert len(writes) == 1
    assert writes[0]._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    assert done.counts == {"accepted": 858, "rejected": 142}
    assert sorted((r.o, r.id) for r in done.accepted.collect()) == [(i, i + 10) for i in range(1000) if i % 7 < 6]
    assert sorted(int(r.id) for r in done.rejected.collect()) == [i + 10 for i in range(1000) if i % 7 == 6]
    assert not any(str(tmp_path) in f for df in (done.accepted, done.rejected) for f in df.inputFiles())


def test_counts_of_an_empty_batch(spark):
    none = spark.createDataFrame([], "o int, a int")
    done = constraints.append(none, [Unique(("a",))], ["o"], ids="id")
    assert done.accepted.isEmpty() and done.rejected.isEmpty() and done.counts == {"accepted": 0, "rejected": 0}
    assert done.accepted.columns == ["id", "o", "a"]


def test_a_numbered_batch_is_moved_by_its_order_and_once_by_its_key(spark, monkeypatch):
    """Keys of the target and of the batch are one list, and neither outcome is moved to learn its numbers."""
    rows = [(5, 1, None), (1, 1, None), (2, 2, "x"), (4, None, "y"), (3, None, "y"), (6, None, None), (7, None, None), (8, 3, "z")]
    batch = spark.createDataFrame(rows, "o int, a int, b string")
    held = spark.createDataFrame([(2, "x"), (None, None), (9, "x")], "a long, b string")
    writes = []
    monkeypatch.setattr(constraints, "publish", lambda df, *a: writes.append(df) or publish(df, *a))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as on a batch too large for one
    try:
        done = constraints.append(batch, [Check("o under 8", "o < 8"), Unique(("a", "b"))], ["o"], target=held, ids="id")
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (done.accepted, done.rejected)]
        kept = sorted((r.o, r.id) for r in done.accepted.collect())
        lost = sorted((int(r.o), r.error_number) for r in done.rejected.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kept == [(1, 1), (3, 3), (6, 6), (7, 7)]
    assert lost == [(2, 1), (4, 1), (5, 1), (8, 2290)]
    assert writes[-1]._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1
    assert not any("SortMergeJoin" in p for p in plans)
