"""The key ledger of a stream: what a batch reads of it, and what gathering and repeating leave unchanged."""

import random

from pensio.operators.constraints import Unique
from pensio.streaming import ledger as module
from pensio.streaming.ledger import KeyLedger

RANGES = 16


def make(spark, tmp_path):
    return KeyLedger(spark, str(tmp_path / "keys"), Unique(("a", "b")), ("int", "string"), RANGES)


def keys(df):
    return set() if df is None else {(r.a, r.b) for r in df.collect()}


def files_read(df) -> int:
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().get("numFiles").get().value()


def test_files_read_stay_bounded_over_fifty_batches(spark, tmp_path):
    """Every batch spreads its three keys over the whole range of values, which minima and maxima could not tell apart."""
    r, kept, most, held = random.Random(1), make(spark, tmp_path), 0, set()
    for number in range(50):
        rows = [(number, "low"), (10_000 - number, "high"), (5000 + r.choice([-1, 1]) * number, None)]
        batch = spark.createDataFrame(rows, "a int, b string").coalesce(1)
        found = kept.taken(batch, f"q_{number}")
        if number:
            assert held & set(rows) <= keys(found) <= held
            most = max(most, files_read(found))
        kept.add(batch, f"q_{number}", number)
        held |= set(rows)
    # Three ranges of sixteen; at most one file a batch in level 0 and one a gathering in level 1.
    assert most <= 3 * 2 * module.MERGE
    assert most < 50
    everything = spark.range(400).selectExpr("cast(id as int) a", "'x' b")
    assert keys(kept.taken(everything, "none")) == held


def test_own_keys_are_free_and_repeats_change_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "MERGE", 2)
    kept = make(spark, tmp_path)
    one, two = (spark.createDataFrame(v, "a int, b string") for v in ([(1, "x"), (2, None), (None, None)], [(3, "y")]))
    assert kept.taken(one, "q_0") is None
    kept.add(one, "q_0", 0)
    kept.add(one, "q_0", 0)  # run again
    assert keys(kept.taken(one, "q_0")) == set()
    assert keys(kept.taken(one, "q_1")) == {(1, "x"), (2, None)}  # a wholly missing key is none
    kept.add(two, "q_1", 1)  # gathers level 0
    kept._write(one.selectExpr("*", "'q_0' as batch"), 0)  # as if the clearing had been stopped
    kept._gather(0)
    assert keys(kept.taken(one.union(two), "q_2")) == {(1, "x"), (2, None), (3, "y")}
    assert keys(kept.taken(one.union(two), "q_1")) == {(1, "x"), (2, None)}


def test_a_stopped_first_write_does_not_count(spark, tmp_path):
    kept = make(spark, tmp_path)
    (tmp_path / "keys" / "_temporary").mkdir(parents=True)
    assert not kept.exists()
