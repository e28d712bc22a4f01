"""Windows in buckets and lookups by day against plain SQL, and how often their inputs are read."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from conftest import DATA, spark_rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pensio.operators.intervals import asof_join, count_in_ranges, interval_join
from pensio.operators.ordering import windowed
from pensio.plans import contracts, restrictions

D = dt.date


def scans(df) -> Counter:
    """How often each benchmark table is read by the plan that ran."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return Counter(re.findall(r"FileScan parquet .*?Location: [^\[]*\[[^\]]*/(\w+)\.parquet", final))


@pytest.mark.parametrize(
    ("name", "most"),
    [
        ("addendum_segments", {"lineitem": 1}),
        ("addendum_months", {"lineitem": 1}),
        ("agreements_import", {"orders": 3, "customer": 1}),
        # Current and archived contracts, and the list of exclusions that is made from the archived ones here.
        ("pension_contracts", {"orders": 3, "customer": 1}),
    ],
)
def test_windows_read_their_input_once(spark, name, most):
    found = scans(entry.queries()[name](spark, DATA))
    assert found and all(found[t] <= most[t] for t in found)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_sums_and_last_values(spark, width):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("k"),
        (F.col("id") * 7919 % 701).alias("o"),
        F.col("id").alias("t"),
        F.when(F.col("id") % 5 == 0, F.col("id") * 31 % 17).alias("v"),
    )
    got = windowed(df, ["k"], ["o", "t"], bucket=[F.floor(F.col("o") / width)], sums={"s": "v"}, carry={"c": "v"})
    over = "OVER (PARTITION BY k ORDER BY o, t ROWS UNBOUNDED PRECEDING)"
    want = spark.sql(f"SELECT *, coalesce(sum(v) {over}, 0) AS s, last_value(v) IGNORE NULLS {over} AS c FROM {{df}}", df=df)
    assert spark_rows(got) == spark_rows(want)


def test_equal_rows_are_kept(spark):
    df = spark.createDataFrame([(1, 2)] * 3 + [(1, 3)], "k int, o int")
    got = windowed(df, ["k"], ["o"], bucket=[F.col("o")], rn="rn", cnt="cnt").collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 1, 4), (1, 2, 2, 4), (1, 2, 3, 4), (1, 3, 4, 4)]


def days(r, n, hot=0.0):
    first = D(1996, 1, 1)
    return [
        (None if r.random() < 0.03 else 7 if r.random() < hot else r.randrange(20),
         None if r.random() < 0.03 else first + dt.timedelta(r.randrange(1500)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_marks_are_counted_in_ranges(spark, hot):
    r = random.Random(1)
    marks = days(r, 3000, hot)
    ranges = [
        (i, k, lo, None if lo is None or r.random() < 0.05 else lo + dt.timedelta(r.randint(-5, 400)))
        for i, (k, lo) in enumerate(days(r, 800, hot))
    ]
    got = count_in_ranges(
        spark.createDataFrame(ranges, "id int, k int, lo date, hi date"), spark.createDataFrame(marks, "k int, d date"),
        key="k", lo="lo", hi="hi", mark="d", out="n",
    )
    by_key = {}
    for k, d in marks:
        by_key.setdefault(k, set()).add(d)
    want = {
        i: sum(lo <= d <= hi for d in by_key.get(k, ()) if d) if k is not None and lo and hi else 0
        for i, k, lo, hi in ranges
    }
    assert {x.id: x.n for x in got.collect()} == want
    assert not re.search(r"Cartesian|NestedLoop", got._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_the_open_interval_is_the_one_that_holds_the_day(spark, hot):
    r = random.Random(2)
    points = [(i, k, d) for i, (k, d) in enumerate(days(r, 2000, hot))]
    intervals = []
    for k in range(20):
        at = D(1, 1, 1)
        for j in range(r.randint(0, 12)):
            to = D(1996, 1, 1) + dt.timedelta(r.randrange(120) + 130 * j)
            intervals.append((k, f"{k}.{j}", at, to if r.random() < 0.9 else at - dt.timedelta(1) if j else to))
            at = to + dt.timedelta(r.choice([1, 1, 40]))
    p = spark.createDataFrame(points, "id int, k int, d date")
    v = spark.createDataFrame(intervals, "k int, name string, lo date, hi date")
    got = asof_join(p, v, key="k", point="d", lo="lo", hi="hi")
    assert spark_rows(got) == spark_rows(interval_join(p, v, key="k", point="d", lo="lo", hi="hi"))
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_closed_gap_paid_throughout_is_cancelled_only_when_fixed(table):
    """The gap 11 March to 10 June touches four months: four different days of them must be paid."""
    row = dict(nom_vkl=9, nom_ips=1, kod_ogr_pv=3, ssylka_fl=1)
    current = table(
        "sp_ogr_pv",
        dict(row, id=1, nach_deistv=D(2000, 1, 1), okon_deistv=D(2000, 3, 10)),
        dict(row, id=2, nach_deistv=D(2000, 6, 11), okon_deistv=D(2000, 7, 1)),
    )
    view = restrictions.sp_ogr_pv(
        current, table("sp_ogr_pv_arh"), table("sp_lspv", dict(ssylka_fl=1, status_pen="и")),
        restrictions.sp_invalid(table("sp_invalid"), table("sp_invalid_arh")),
    )
    dog = table("sp_pen_dog", dict(nom_vkl=9, ssylka=1, data_nach_vypl=D(1995, 1, 1), ref_kodinsz=1))
    periods = contracts.contract_periods(contracts.pension_contracts(dog, table("sp_lspv"), table("sp_pen_dog_arh")))
    four = [D(2000, 3, 1), D(2000, 4, 30), D(2000, 5, 5), D(2000, 6, 30)]
    for paid, flag in ((four, "Y"), (four[:3] + four[:1], "N"), (four[:3] + [D(2000, 7, 1)], "N"), (four + [D(2000, 6, 1)], "N")):
        pay = table("vypl_pen", *[dict(ssylka_fl=1, data_nachisl=d) for d in paid])
        for fixed, wanted in ((True, flag), (False, "N")):
            got = restrictions.restrictions_by_contract(restrictions.sp_ogr_pv_rev(view), periods, pay, fixed=fixed)
            assert {r.id: r.is_cancel for r in got.collect()}[1] == wanted


def test_some_registered_restriction_is_cancelled_by_the_fixed_test(spark):
    plain, fixed = (entry.queries()[n](spark, DATA) for n in ("restrictions_by_contract", "restrictions_fixed"))
    assert plain.where("is_cancel = 'Y'").count() < fixed.where("is_cancel = 'Y'").count()
