from __future__ import annotations

import os
import sys
from collections import Counter

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pensio import schemas  # noqa: E402
from pensio.session import session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("orders", "customer", "lineitem", "events")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": 4,
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    spark = session("tests", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def table(spark):
    """Builds a table of the model from rows that name only the columns that matter."""

    def build(name, *rows):
        schema = schemas.schema(name)
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)

    return build


def as_rows(names, data) -> Counter:
    """Rows as text, columns by name: what two engines are compared by."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(None if r[i] is None else str(r[i]) for i in order) for r in data)


def spark_rows(df) -> Counter:
    return as_rows(df.columns, df.collect())


def sql_rows(folder, sql) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    answer = con.sql(sql)
    return sorted(answer.columns), as_rows(answer.columns, answer.fetchall())
