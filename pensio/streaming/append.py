"""Validated append as a Structured Streaming sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from pensio.operators.constraints import Unique, append, with_defaults
from pensio.operators.ordering import numbered
from pensio.sources.snapshots import stage
from pensio.streaming.ledger import RANGES, KeyLedger


def append_stream(
    stream: DataFrame,
    target_path: str,
    reject_path: str,
    checkpoint: str,
    rules,
    order: list[str],
    *,
    unique_target: bool = True,
    ids: str | None = None,
    first_id: int = 1,
    ranges: int = RANGES,
    defaults: dict[str, Column] | None = None,
    tag: str | None = None,
) -> DataStreamWriter:
    """Micro-batch form of ``append_with_rejects``: one batch is one push-and-flush.

    A batch writes a folder of its own in both tables, named by the stream's id and the batch's number, so a batch
    that is run again after a lost driver replaces only itself, and a stream with a new checkpoint adds to what is
    there. Unique keys are checked against a ledger of keys beside the table (``<target_path>_keys``), of which a batch
    reads the hash ranges it touches; it is made once for a table that already holds rows.

    ``ids`` is numbered from ``first_id`` over all batches, rejected rows included. The last number of each batch
    is kept in ``<reject_path>_ids``, one row a batch, so no history is read to go on. ``defaults`` and ``tag`` are those
    of ``append_with_rejects``.

    A batch is written once before it is judged, with ``ids`` in range pieces of its order, from whose sizes the numbers
    follow.
    """
    unique = [r for r in rules if isinstance(r, Unique)] if unique_target else []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}_{batch_id}"
        batch, numbers = with_defaults(batch, defaults), {}
        if not ids:
            batch = stage(batch)  # judged, and asked for its ranges of keys
        else:
            given = batch.columns if ids in batch.columns else [ids, *batch.columns]
            batch = numbered(batch.drop(ids), order, "_number")
            batch = batch.withColumn(ids, F.lit(None).cast("long")).select(*given, "_number")
            last = _others(spark, f"{reject_path}_ids", own, "last_id long")
            start = (last.agg(F.max("last_id")).first()[0] if last is not None else None) or first_id - 1
            numbers = {"ids": ids, "first_id": start + 1, "number": "_number"}
        ledgers = [
            KeyLedger(spark, f"{target_path}_keys/rule={i}", r, _types(batch, r), ranges) for i, r in enumerate(unique)
        ]
        target = {}
        for ledger in ledgers:
            if not ledger.exists():
                held = _others(spark, target_path, own, ", ".join(f"`{c}` {t}" for c, t in zip(ledger.rule.columns, ledger.types)))
                if held is not None:
                    ledger.add(held, "before", 0)
            found = ledger.taken(batch, own)
            if found is not None:
                target[ledger.rule.name] = found
        done = append(batch, rules, order, target=target, tag=tag, **numbers)
        accepted, rejected = done.accepted, done.rejected
        accepted.write.mode("overwrite").parquet(f"{target_path}/batch={own}")
        rejected.write.mode("overwrite").parquet(f"{reject_path}/batch={own}")
        for ledger in ledgers:
            ledger.add(accepted, own, batch_id)
        if ids:
            counted = batch.groupBy().agg((F.count(F.lit(1)) + start).alias("last_id"))
            counted.write.mode("overwrite").parquet(f"{reject_path}_ids/batch={own}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def _types(batch: DataFrame, rule: Unique) -> tuple[str, ...]:
    return tuple(batch.schema[c].dataType.simpleString() for c in rule.columns)


def _others(spark: SparkSession, path: str, own: str, ddl: str) -> DataFrame | None:
    """What other batches wrote under ``path``; None if there is nothing yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(f"{ddl}, batch string").parquet(path).where(F.col("batch") != own)
