"""The keys a table holds, kept beside it so that a batch learns which of its own are taken without reading the table.

Keys are rows of (key columns, batch) in folders by hash range, ``level=<n>/range=<r>``: a batch reads only the ranges
its keys fall into. Every batch adds a file to the ranges it touches. So that files do not pile up, every ``MERGE``-th
batch gathers the files of level 0 into one a range in level 1, every ``MERGE``-th of those into level 2, and so on: a
range holds at most ``MERGE`` files a level and a key is rewritten once a level.

Keys are a set and say who wrote them. Writing them again, by a batch that is run a second time or by a gathering that
was stopped between its writing and its clearing, changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pensio.operators.constraints import Unique, any_present

RANGES = 64
MERGE = 8


@dataclass(frozen=True)
class KeyLedger:
    """Keys of one unique rule under ``path``; ``types`` are those of its columns. ``ranges`` must not change later."""

    spark: SparkSession
    path: str
    rule: Unique
    types: tuple[str, ...]
    ranges: int = RANGES

    @property
    def _ddl(self) -> str:
        fields = [f"`{c}` {t}" for c, t in zip(self.rule.columns, self.types)]
        return ", ".join([*fields, "batch string", "level int", "range int"])

    def _range(self) -> Column:
        return F.pmod(F.xxhash64(*self.rule.columns), F.lit(self.ranges)).cast("int")

    def _folder(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        """Whether a write was completed; one that was stopped before does not count."""
        path, fs = self._folder("_SUCCESS")
        return fs.exists(path)

    def taken(self, batch: DataFrame, own: str) -> DataFrame | None:
        """Keys that other batches hold in the ranges in which ``batch`` has keys; None before anything was written.

        The number of ranges is fixed, and so is the list of those asked for.
        """
        if not self.exists():
            return None
        asked = batch.where(any_present(self.rule.columns)).select(self._range().alias("r")).distinct().collect()
        held = self.spark.read.schema(self._ddl).parquet(self.path)
        return held.where(F.col("range").isin([row.r for row in asked]) & (F.col("batch") != own)).select(*self.rule.columns)

    def add(self, rows: DataFrame, own: str, number: int) -> None:
        """Adds the keys of ``rows``, the accepted rows of batch ``own``, which is the ``number``-th (from 0)."""
        self._write(rows, 0, own)
        level, due = 0, number + 1
        while due % MERGE == 0:
            self._gather(level)
            level, due = level + 1, due // MERGE

    def _write(self, rows: DataFrame, level: int, own: str | None = None) -> None:
        """Writes the keys of ``rows``, which batch ``own`` wrote; without, their column ``batch`` says who."""
        keys = rows.where(any_present(self.rule.columns)).select(*self.rule.columns, *([] if own else ["batch"]))
        # Equal keys share a range, so they are moved once, and a batch's name is put beside its keys after that.
        keys = keys.withColumn("range", self._range()).repartition("range").distinct()
        keys = keys.withColumn("level", F.lit(level)).withColumns({} if not own else {"batch": F.lit(own)})
        keys.write.mode("append").partitionBy("level", "range").parquet(self.path)

    def _gather(self, level: int) -> None:
        folder, fs = self._folder(f"level={level}")
        if fs.exists(folder):
            self._write(self.spark.read.schema(self._ddl).parquet(self.path).where(F.col("level") == level), level + 1)
            fs.delete(folder, True)
