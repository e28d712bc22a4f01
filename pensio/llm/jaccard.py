"""Jaccard self-join on word shingles by a grouped prefix join, and the groups its links form.

A document's set is its distinct shingles. In one order for all sets - shingles frequent in a sample last, else by
hash - two sets that link share a shingle among their first ones, the prefix. Steps:

1. One pass gives each text its set's size and hash and its prefix. Equal sets are one node, named by the smallest
   doc_id. Nodes with equal prefix and size form a group, which enters the join once.
2. Prefix shingles of a single group are dropped. Within the others, each group meets the group in whose order the
   shingle comes first; and the members of a group meet its first. What meets is filtered by counts of shingles
   in 64 parts of the hash range, then verified on the texts, and links make first components. So a cloud of near copies costs one pair per member and shingle.
3. Only nodes that share a shingle and are still apart can add a link. For each shingle, those outside its most
   frequent component meet all others of a different component that pass the size and position filters (group pairs
   expanded to members), and are verified. The members of one group share their whole prefix, also where no other
   group has its shingles: the group itself stands for a shingle at place 0.

Step 3 is complete: a pair left out is equal, already connected, or cannot reach the threshold. The sample only sets
the order, which never changes the result. Sets are told apart by 64-bit hashes of shingles and sets.

Null texts and texts without words have an empty set and link with nothing. ``doc_id`` names a text: repeated rows are
expected to repeat it, and each gets its row of the result. A NULL doc_id has a size but no component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pensio.llm.common import Words, components, map_batches, mix, small, stage, without

SHINGLE = 3
PERCENT = 90
CELLS = 64  # parts of the hash range that a set's shingles are counted in
SAMPLE_SHARE = 8  # one document in so many is looked at for frequent shingles, which are put last
FREQUENT = 2
LISTED = 1_000_000  # frequent shingles that are sent to the tasks, at most

def prefix_size(n, percent: int):
    """Shingles of a set of ``n`` that a link with any set must share one of."""
    return n - (percent * n + 99) // 100 + 1


def frequent(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in at least ``FREQUENT`` documents of the sample, sorted, and their counts.

    The sample is a fixed share of the documents, so what counts as frequent does not change with their number. Where
    more than ``LISTED`` shingles are, the rarest of them are left out.
    """

    def make():
        def step(batch):
            h, n = np.unique(Words(batch.column("text")).sets(size)[1], return_counts=True)
            return {"h": h, "n": n}

        return step

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_SHARE)) == 0).select("text")
    counted = stage(
        map_batches(sample, "h long, n long", make).groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    )
    # As many rows as there are different counts.
    tally = sorted(((r.n, r.rows) for r in counted.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).collect()), reverse=True)
    least, listed = FREQUENT, 0
    for n, rows in tally:
        listed += rows
        if listed > LISTED:
            least = n + 1
            break
    rows = counted.where(F.col("n") >= least).toArrow()
    h = rows.column("h").to_numpy().astype(np.int64).view(np.uint64)
    at = np.argsort(h)
    return h[at], rows.column("n").to_numpy().astype(np.int64)[at]


def prefixes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n, s, g, prefix, sketch): set size, set hash, group hash, the prefix in the common order, and how
    many shingles lie in each part of the hash range."""
    heavy, count = frequent(docs, size)

    def make():
        def step(batch):
            rows, h = Words(batch.column("text")).sets(size)
            n = np.bincount(rows, minlength=batch.num_rows)
            sums = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(mix(h), out=sums[1:], dtype=np.uint64)
            ends = np.cumsum(n)
            s = mix(sums[ends] - sums[ends - n] + n.astype(np.uint64))
            cells = np.bincount(rows * CELLS + (h >> np.uint64(58)).astype(np.int64), minlength=batch.num_rows * CELLS)
            cells = cells.astype("<u4").reshape(-1, CELLS)
            sketch = [c.tobytes() for c in cells]
            rank = np.zeros(len(h), np.int64)
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, h), len(heavy) - 1)
                rank = np.where(heavy[at] == h, count[at], 0)
                order = np.lexsort((h, rank, rows))
                rows, h = rows[order], h[order]
            place = np.arange(len(h)) - np.repeat(ends - n, n)
            keep = place < prefix_size(n, percent)[rows]
            rows, h, place = rows[keep], h[keep], place[keep]
            sizes = np.bincount(rows, minlength=batch.num_rows)
            sums = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(mix(h + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), out=sums[1:], dtype=np.uint64)
            ends = np.cumsum(sizes)
            g = mix(sums[ends] - sums[ends - sizes] + n.astype(np.uint64))
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            prefix = pa.ListArray.from_arrays(offsets, pa.array(h.view(np.int64)))
            return {"doc_id": batch.column("doc_id"), "n": n, "s": s, "g": g, "prefix": prefix, "sketch": sketch}

        return step

    return map_batches(docs.select("doc_id", "text"), "doc_id long, n long, s long, g long, prefix array<long>, sketch binary", make)


def likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) that may link: each set's shingles are counted in ``CELLS`` parts of the hash range, and two
    sets share no more in a part than the smaller count. Unrelated sets fall far short, so no text is moved for them."""
    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))

    def make():
        def step(batch):
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, CELLS).astype(np.int64)
                for c in ("sketch_a", "sketch_b")
            )
            most = np.minimum(one, two).sum(1)
            keep = pa.array(np.flatnonzero(most * (100 + percent) >= (one.sum(1) + two.sum(1)) * percent))
            return {c: batch.column(c).take(keep) for c in ("a", "b")}

        return step

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "sketch_a", "sketch_b")
    return map_batches(joined, "a long, b long", make)


def verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``pairs`` (a, b) that link."""
    pairs = stage(likely(pairs, sketches, percent))
    nodes = stage(pairs.select(F.col("a").alias("w_node")).union(pairs.select("b")).distinct())
    texts = stage(
        docs.select(F.col("doc_id").alias("node"), "text")
        .join(small(nodes), F.col("node") == F.col("w_node"))
        .dropDuplicates(["node"])
        .select("node", "text")
    )
    return verify(pairs, texts, size).where(linked(percent)).select("a", "b")


def verify(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """``pairs`` (a, b) with the sizes of the sets' intersection (``both``) and union (``any``)."""
    left = texts.select(F.col("node").alias("a"), "text")
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text", "text_b")

    def make():
        def step(batch):
            one, two = (Words(batch.column(c)).sets(size) for c in ("text", "text_b"))
            rows, h = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
            order = np.lexsort((h, rows))
            rows, h = rows[order], h[order]
            twice = (rows[1:] == rows[:-1]) & (h[1:] == h[:-1])
            both = np.bincount(rows[1:][twice], minlength=batch.num_rows)
            return {
                "a": batch.column("a"),
                "b": batch.column("b"),
                "both": both,
                "any": np.bincount(rows, minlength=batch.num_rows) - both,
            }

        return step

    return map_batches(joined, "a long, b long, both long, any long", make)


def linked(percent: int) -> Column:
    return F.col("both") * 100 >= F.col("any") * percent


def fits(percent: int, x: str, y: str) -> Column:
    """Whether sets with a shingle at places ``x.pos`` and ``y.pos`` as their first common one can link."""
    nx, ny, px, py = (F.col(c) for c in (f"{x}.n", f"{y}.n", f"{x}.pos", f"{y}.pos"))
    most = F.least(nx - px, ny - py)
    return (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent) & (
        most * (100 + percent) >= (nx + ny) * percent
    )


def similar(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    sets = stage(prefixes(docs, size, percent))
    named = sets.where("n > 0 and doc_id is not null")
    nodes = stage(
        named.groupBy("s").agg(F.min("doc_id").alias("node"), F.min("n").alias("n"), F.min("g").alias("g"))
    )
    exploded = named.select("g", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = stage(
        exploded.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo < hi").select("token")
    )
    bucket = stage(
        exploded.join(small(shared), "token").groupBy("token", "g").agg(F.min("n").alias("n"), F.min("pos").alias("pos"))
    )
    groups = nodes.groupBy("g").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("members"))
    groups = stage(groups.join(bucket.select("g").distinct().withColumn("met", F.lit(True)), "g", "left")
                   .where("members > 1 or met"))
    members = stage(nodes.join(groups, "g").select("g", "first", "node", "n"))
    sketches = stage(
        sets.select(F.col("doc_id").alias("node"), "sketch")
        .join(small(members.select(F.col("node").alias("w_node")).distinct()), F.col("node") == F.col("w_node"))
        .dropDuplicates(["node"])
        .select("node", "sketch")
    )
    # First meetings: the group in which a shingle comes first, for sets of about one size.
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent))).alias("band")
    banded = bucket.select("token", "g", "n", "pos", band)
    heads = stage(banded.groupBy("token", "band").agg(F.min(F.struct("pos", "n", "g")).alias("h")))
    meets = (
        banded.alias("x").join(
            heads.select("token", "band", F.col("h.pos").alias("pos"), F.col("h.n").alias("n"), F.col("h.g").alias("g"))
            .alias("y"),
            ["token", "band"],
        )
        .where(F.col("x.g") != F.col("y.g")).where(fits(percent, "x", "y"))
        .select(F.col("x.g").alias("g"), F.col("y.g").alias("h")).distinct()
    )
    first = groups.select("g", "first")
    between = meets.join(first.withColumnRenamed("first", "a"), "g").join(
        first.select(F.col("g").alias("h"), F.col("first").alias("b")), "h"
    )
    within = members.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    pairs = stage(
        between.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).unionByName(within).distinct()
    )
    links = stage(verified(pairs, sketches, docs, size, percent))
    parts = stage(components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    # Different sets of one size n share n - 1 of n + 1 shingles at most.
    inner = members.where((F.col("node") != F.col("first")) & ((F.col("n") - 1) * 100 >= (F.col("n") + 1) * percent))
    inner = inner.select(F.col("g").alias("token"), "g", F.lit(0).alias("pos")).distinct()
    apart = _apart(bucket.select("token", "g", "pos").unionByName(inner), members, parts, percent).join(pairs, ["a", "b"], "left_anti")
    more = stage(verified(apart, sketches, docs, size, percent))
    both = links.unionByName(more).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    whole = parts if more.isEmpty() else components(both)
    of = nodes.select("s", "node").join(whole, "node", "left").select("s", F.coalesce("component_id", "node").alias("c"))
    found = sets.where("n > 0 and doc_id is not null").select("doc_id", "n", "s").join(stage(of), "s")
    rest = sets.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("c"))
    return found.select("doc_id", "n", "c").unionByName(rest).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("c").alias("component_id")
    )


def _apart(bucket: DataFrame, members: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes that share a prefix shingle, are in different components, and can link."""
    rows = stage(
        bucket.select("token", "g", "pos")
        .join(members.select("g", "node", "n"), "g")
        .join(parts, "node", "left")
        .select("token", "node", "n", "pos", F.coalesce("component_id", "node").alias("c"))
    )
    counts = rows.groupBy("token", "c").agg(F.count(F.lit(1)).alias("k"))
    major = stage(
        counts.groupBy("token").agg(F.max(F.struct("k", "c")).alias("m"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1").select("token", F.col("m.c").alias("major"))
    )
    mixed = stage(rows.join(small(major), "token"))
    outside = stage(mixed.where("c <> major"))
    x, y = outside.alias("x"), mixed.alias("y")
    return (
        x.join(y, "token")
        .where((F.col("x.c") != F.col("y.c")) & fits(percent, "x", "y"))
        .select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"))
        .distinct()
    )


def deduplicate(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of linked ones: the one with the smallest doc_id.

    Rows without doc_id, text or words stay; so do all rows that carry the smallest doc_id, if it is repeated.
    """
    return without(docs, similar(docs, size, percent).where("component_id <> doc_id").select("doc_id"))
