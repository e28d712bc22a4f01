"""One key with a third of all rows."""

import pytest
import skew
from conftest import DATA, spark_rows, sql_rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pensio.operators import ordering


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    target = tmp_path_factory.mktemp("skewed")
    skew.write_skewed(DATA, str(target))
    return str(target)


@pytest.mark.parametrize(
    "name",
    [
        "pension_contracts",
        "payments_by_contract",
        "payments_by_contract_asof",
        "restrictions_fixed",
        "sp_ogr_pv_rev",
        "restrictions_by_contract",
        "registry_pay_orders",
        "addendum_segments",
        "addendum_months",
        "agreements_import",
        "participant_balance",
        "cancel_restrictions",
        "reopen_addenda",
        "append_unique",
    ],
)
def test_hot_key(spark, folder, name):
    got = spark_rows(entry.queries()[name](spark, folder))
    assert got == sql_rows(folder, entry.oracle_sql()[name])[1]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_windowed_is_the_plain_window(spark, width):
    """Numbering in buckets agrees with it, with NULL keys, NULLs in the order and NULL neighbours."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 7 > 0, F.col("id") % 11)).alias("k"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 50).alias("o"),
        F.col("id").alias("t"),
        F.when(F.col("id") % 4 > 0, F.col("id") * 7 % 13).alias("v"),
    )
    got = ordering.windowed(
        df, ["k"], ["o", "t"], bucket=[F.floor(F.col("o") / width)], rn="rn", cnt="cnt", lead={"next_v": "v"},
        lag={"last_v": "v"},
    )
    over = "OVER (PARTITION BY k ORDER BY o NULLS LAST, t)"
    want = spark.sql(
        f"""SELECT k, o, t, v, lead(v) {over} AS next_v, lag(v) {over} AS last_v,
                   row_number() {over} AS rn, count(*) OVER (PARTITION BY k) AS cnt FROM {{df}}""",
        df=df,
    )
    assert spark_rows(got) == spark_rows(want)


def test_pieces_are_even(spark):
    df = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = ordering.numbered(df, ["id"], "rn")
        read = cut.groupBy(F.floor((F.col("rn") - 1) / 10_000)).count().count()
        pieces = stage_sizes(spark, df)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert cut.where("rn <> id + 1").isEmpty() and read == 4
    assert max(pieces) < 1.3 * 40_000 / len(pieces)


def stage_sizes(spark, df):
    cut = df.repartitionByRange("id")
    return [r["n"] for r in cut.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


def test_no_job_runs_while_a_window_is_built(spark, folder):
    from pensio.demo.catalog import Plans

    plans = Plans(spark, folder)
    for table in ("sp_pen_dog", "sp_pen_dog_arh", "sp_lspv", "contract_exclusions", "pension_agreement_addendums"):
        getattr(plans, table)  # opening a file looks at its schema
    spark.sparkContext.setJobGroup("build", "build")
    try:
        for view in (plans.v_contracts, plans.v_segments):
            assert view.columns
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ids_are_dense_and_in_order(spark):
    from pensio.operators.rows import with_ids

    df = spark.range(5000).select(F.concat(F.lit("x"), F.lpad("id", 5, "0")).alias("name"))
    got = with_ids(df, "id", ["name"], 100).orderBy("name").collect()
    assert [r["id"] for r in got] == list(range(100, 5100))
