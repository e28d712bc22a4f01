"""Several unique keys at once: first come, first served."""

import random

from pensio.operators import constraints
from pensio.operators.constraints import Unique, append_with_rejects


def greedy(rows):
    """(place, key, key): first come, first served."""
    taken, out = set(), {}
    for place, *keys in sorted(rows):
        used = [(i, k) for i, k in enumerate(keys) if k is not None]
        hit = [x for x in used if x in taken]
        out[place] = not hit
        if not hit:
            taken.update(used)
    return out


def judged(spark, rows):
    df = spark.createDataFrame(rows, "place int, a int, b int")
    accepted, rejected = append_with_rejects(df, [Unique(("a",)), Unique(("b",))], ["place"])
    return {r.place: True for r in accepted.collect()} | {int(r.place): False for r in rejected.collect()}


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """Each row shares one key with the row before it and the other with the next."""
    n = 10_000
    rows = [(i, (i + 1) // 2, -1 - i // 2) for i in range(n)]
    steps = []
    for name in ("_skip", "_earlier_rivals"):
        real = getattr(constraints, name)
        monkeypatch.setattr(constraints, name, lambda *a, real=real: steps.append(1) or real(*a))
    assert judged(spark, rows) == greedy(rows)
    assert len(steps) <= 20


def test_several_keys_are_first_come_first_served(spark):
    r = random.Random(4)
    chains, dense = [], []
    for i in range(300):  # broken chains, both keys in common with one rival, keys that are missing
        chains.append((i, r.choice([None, i // 2, i // 3]), r.choice([None, (i + 1) // 2, i // 3])))
    for i in range(300):  # rows with many rivals in both keys
        dense.append((i, r.randrange(40), r.randrange(40)))
    for rows in (chains, dense):
        assert judged(spark, rows) == greedy(rows)


def test_places_are_whole_numbers_where_none_is_missing(spark):
    """A missing place comes last; without one, a place is the plain column, which has minima in hash tables."""
    df = spark.createDataFrame([(1, 5, 7), (2, 5, 8), (None, 6, 8), (2**63 - 1, 6, 9)], "place long, a int, b int")
    accepted, rejected = append_with_rejects(df, [Unique(("a",)), Unique(("b",))], ["place"])
    assert sorted(r.place for r in accepted.collect()) == [1, 2**63 - 1]
    assert sorted(str(r.place) for r in rejected.collect()) == ["2", "None"]
    whole = df.where("place is not null")
    assert whole.select(constraints._place(whole, ["place"]).alias("p")).schema["p"].dataType.simpleString() == "bigint"
