"""Writing results as snapshots and continuing from them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pensio.session import scratch_dir


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes a snapshot, replacing what is at ``path``, and reads it back with the same schema.

    ``path`` must not be one that ``df`` reads from. An assignments table partitioned by its run column lets a
    single run be found without a scan.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame) -> DataFrame:
    """Writes an intermediate result to the shared scratch folder and continues from there.

    For results that later steps read more than once: they are computed once, a lost executor costs a read instead
    of a recomputation, and the planner knows the true size of what it joins.
    """
    return publish(df, scratch_dir(df.sparkSession))


def unstage(df: DataFrame) -> None:
    """Removes the copy a staged DataFrame reads, once nothing reads it any more."""
    jvm = df.sparkSession._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
