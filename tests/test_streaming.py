"""The validated append as a stream of micro-batches."""

import os
from pathlib import Path

import __spark_entry__ as entry
from pensio.demo import catalog
from pensio.operators.constraints import NotNull, Unique
from pensio.streaming.append import append_stream


def test_batches_are_judged_against_earlier_ones_and_repeatable(spark, tmp_path):
    source, target, rejects = (str(tmp_path / n) for n in ("in", "out", "err"))
    schema = "o int, a int"
    rules = [NotNull("a"), Unique(("a",))]

    def deliver(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def drain(checkpoint):
        stream = spark.readStream.schema(schema).parquet(source)
        query = append_stream(stream, target, rejects, str(tmp_path / checkpoint), rules, ["o"], tag="s")
        query.trigger(availableNow=True).start().awaitTermination(120)

    deliver((1, 1), (2, 1), (3, None))
    drain("cp")
    deliver((4, 1), (5, 2))
    drain("cp")
    taken = lambda: sorted(r["o"] for r in spark.read.parquet(target).collect())
    refused = lambda: sorted((r["o"], r["error_number"]) for r in spark.read.parquet(rejects).collect())
    assert taken() == [1, 5]
    assert refused() == [("2", 1), ("3", 1400), ("4", 1)]

    # The last batch runs again when its commit mark is lost: nothing is doubled.
    os.remove(tmp_path / "cp" / "commits" / "1")
    crc = tmp_path / "cp" / "commits" / ".1.crc"
    if crc.exists():
        os.remove(crc)
    drain("cp")
    assert taken() == [1, 5]
    assert refused() == [("2", 1), ("3", 1400), ("4", 1)]


def test_ids_and_keys_go_on_over_batches_and_checkpoints(spark, tmp_path):
    source, target, rejects = (str(tmp_path / n) for n in ("in", "out", "err"))
    schema = "o int, a int, id long"
    rules = [NotNull("a"), Unique(("a",))]

    def deliver(*rows):
        spark.createDataFrame([(*r, None) for r in rows], schema).coalesce(1).write.mode("append").parquet(source)

    def drain(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = append_stream(stream, target, rejects, str(tmp_path / checkpoint), rules, ["o"], ids="id", first_id=100)
        query.trigger(availableNow=True).start().awaitTermination(120)

    deliver((1, 1), (2, 1))
    deliver((3, 2), (4, None))
    deliver((5, 3))
    drain("cp")
    taken = lambda: sorted((r["o"], r["id"]) for r in spark.read.parquet(target).collect())
    refused = lambda: sorted((r["o"], r["id"]) for r in spark.read.parquet(rejects).collect())
    assert taken() == [(1, 100), (3, 102), (5, 104)]
    assert refused() == [("2", "101"), ("4", "103")]
    # A new checkpoint reads everything again: the target stays, and every key is taken.
    drain("other")
    assert taken() == [(1, 100), (3, 102), (5, 104)]
    assert sorted(int(i) for _, i in refused()) == [101, 103, 105, 106, 107, 108, 109]


def test_a_part_of_the_demo_stream_is_many_files_and_one_batch(spark, tmp_path, monkeypatch):
    given, data, root = Path("/root/testdata/sf0.001"), tmp_path / "sf", tmp_path / "scratch"
    data.mkdir()
    for table in given.glob("*.parquet"):
        if table.stem != "lineitem":
            (data / table.name).symlink_to(table)
    lines = spark.read.parquet(str(given / "lineitem.parquet"))
    lines.repartition(4).write.parquet(str(data / "lineitem.parquet"))
    monkeypatch.setattr(catalog, "scratch_dir", lambda spark: str(root))
    rows = entry.queries()["append_stream"](spark, str(data))
    assert rows.count() > 0
    assert len(list((root / "arriving").glob("*.parquet"))) > 3
    assert len(list((root / "rejected_ids").glob("batch=*"))) == 3
    given = [r.given for r in rows.where("given is not null").collect()]
    assert len(given) == len(set(given))
