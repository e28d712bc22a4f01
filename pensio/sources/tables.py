"""Reading input tables and creating reject tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pensio import schemas
from pensio.operators.constraints import REJECT_TABLES, reject_schema, reject_table_name


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A Parquet table of the input model, read with its declared schema."""
    return spark.read.schema(schemas.schema(table)).parquet(f"{root.rstrip('/')}/{table}")


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def ensure_reject_table(
    spark: SparkSession, root: str, table: str, schema: T.StructType, name: str | None = None
) -> str:
    """Path of a table's reject table, created empty when it does not exist yet."""
    path = f"{root.rstrip('/')}/{reject_table_name(table, name)}"
    empty_like(spark, reject_schema(schema)).write.mode("ignore").parquet(path)
    return path


def ensure_reject_tables(spark: SparkSession, root: str, layouts: dict[str, T.StructType] | None = None) -> list[str]:
    """Paths of all reject tables of the import, created empty where they do not exist yet.

    A table whose columns the input model does not declare takes them from ``layouts`` (by name, in lower case);
    without, its reject table holds the error columns only.
    """
    paths = []
    for table, name in REJECT_TABLES:
        key = table.lower()
        given = (layouts or {}).get(key) or (schemas.schema(key) if key in schemas.table_names() else T.StructType())
        paths.append(ensure_reject_table(spark, root, table, given, name))
    return paths
