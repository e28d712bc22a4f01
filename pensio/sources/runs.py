"""A table of accruals kept by run: one folder a run, so one run is read, replaced or deleted without the others."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class RunTable:
    """Parquet under ``path``, partitioned by the column ``run`` (a whole number).

    Writers replace whole runs: Spark writes them beside the table and swaps in the folders of the runs that the new
    rows hold. A replaced run must not be read from this table itself in the same step; publish it first.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    run: str = "fk_doc_with_action"

    def read(self) -> DataFrame:
        """All runs; a filter on the run column, a scalar subquery too, limits the folders that are read."""
        rest = T.StructType([f for f in self.schema.fields if f.name != self.run])
        stored = T.StructType([*rest.fields, self.schema[self.run]])
        return self.spark.read.schema(stored).parquet(self.path).select(*self.schema.names)

    def replace(self, rows: DataFrame) -> None:
        """Puts ``rows`` in the place of the runs that occur in them; all other runs stay untouched.

        Columns are cast to the table's types. A run is written by as many tasks as its size asks for.
        """
        (
            rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
            .hint("rebalance", self.run)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.run)
            .parquet(self.path)
        )

    def delete(self, runs: Iterable[int]) -> None:
        """Removes the folders of the given runs; one that does not exist is no error."""
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for run in runs:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/{self.run}={int(run)}")
            folder.getFileSystem(conf).delete(folder, True)

    def runs(self) -> DataFrame:
        """The run numbers held, from the folder names alone."""
        return self.read().select(F.col(self.run)).distinct()
