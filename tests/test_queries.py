"""Every registered query against its SQL counterpart, and the shape of its plan."""

import re

import pytest
from conftest import DATA, spark_rows, sql_rows

import __spark_entry__ as entry
from pensio.demo import catalog, oracles

QUERIES, ORACLES = catalog.queries(), oracles.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(spark, name):
    df = QUERIES[name](spark, DATA)
    columns, want = sql_rows(DATA, ORACLES[name])
    assert sorted(df.columns) == columns
    assert spark_rows(df) == want
    assert want, "the mapped tables should make every query return something"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("NestedLoop|Cartesian|Python", plan)


def test_the_entry_registers_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_is_the_flagship(spark):
    assert entry.entry(spark).columns == ["ssylka_fl", "ref_kodinsz", "data_nach_vypl", "payments", "paid"]
