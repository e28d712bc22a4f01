"""The as-of join against the join by year."""

import datetime as dt
import random
import re

from conftest import spark_rows

from pensio.operators.intervals import asof_join, interval_join

AT = dict(key="k", point="d", lo="lo", hi="hi")


def test_asof_moves_and_sorts_points_once(spark):
    r = random.Random(3)
    day = lambda n: dt.date(1998, 1, 1) + dt.timedelta(days=n)
    held = []
    for k in (None, 1, 2, 3, 4):
        cuts = sorted(r.sample(range(0, 900), 12))  # several starts a month, gaps, and empty intervals
        held += [(k, day(a), day(b - r.choice([1, 1, 9, 400])), f"{k}-{a}") for a, b in zip(cuts, cuts[1:])]
        held += [(k, dt.date(1, 1, 1), day(cuts[0] - 1), "first"), (k, day(cuts[-1]), dt.date(9999, 12, 31), "last"), (k, None, day(5), "none")]
    asked = [(r.choice([None, 1, 1, 1, 2, 5]), r.choice([None, *[day(n) for n in range(-60, 1000)]]), i) for i in range(800)]
    asked += [(1, a, 1000) for _, a, _, _ in held if a] + [(2, day(40), 7)] * 3
    intervals = spark.createDataFrame(held, "k int, lo date, hi date, name string")
    points = spark.createDataFrame(asked, "k int, d date, i int")
    got = asof_join(points, intervals, **AT)
    want = interval_join(points, intervals, **AT)
    assert got.columns == want.columns
    assert spark_rows(got) == spark_rows(want.select(*got.columns)) and got.count() > 200
    # A window that sorts by what a point carries, for an exchange that is read twice, is gone.
    assert not re.search(r"_point#\d+ ASC", got._jdf.queryExecution().optimizedPlan().toString())
