"""Embedding near-duplicates by a robust-pruned flat graph over overlapping cluster shards.

Vectors of one label and length are dealt to cells around centres fitted on a bounded sample: the two nearest and all
nearly as near (``MARGIN``), so cells overlap, the more the more there are, and near vectors share one.  A cell with more vectors than a task should hold is cut into blocks by hash. In each block every vector is
linked to near ones under the robust pruning rule; a vector's lists from its cells are united. A greedy search then
runs from a block's medoids (and from the query's own node, if the block has it) and expands whatever lies within the
range, so a dense group is found whole. Each block of a cell is searched by each other. What is found is verified as
cosine in double precision.

Exact copies are one node with a count. A pair that meets in several cells counts in the first of them. Only counts and
a star around the smallest node of each group leave a task, never all pairs.

Vectors that are NULL, empty, all zero, or hold NULL or non-finite components, and vectors without label, link with
nothing. Vectors of different lengths do not link. A repeated row is one more vector.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pensio.llm.common import components, map_batches, stage, union_find

THRESHOLD = 0.93
CELL = 300  # vectors a centre stands for
BLOCK = 1000  # vectors in one task's graph, about
# A vector joins every cell whose centre is at most this much less similar than the nearest. For pairs at the threshold,
# random vectors of 64 places and random centres, the share of pairs that meet in some cell is 1.00 with 10 to 50 cells,
# 0.999 with 200 and 0.998 with 12,500; a vector is then in 2.6, 3.9, 5.5 and 13 cells. Nearer pairs meet more often.
MARGIN = 0.08
MERGE = 0.8  # centres at least this near are one
SAMPLE = 50_000  # vectors the centres are fitted on, at most
CANDIDATES, DEGREE, ALPHA, NEAREST = 24, 12, 1.2, 3
MEDOIDS = 24
BEAM = 10
SLACK = 0.06  # nodes this far below the threshold are still expanded


def usable() -> Column:
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & fine & some, F.lit(False))


def normalised(rows) -> np.ndarray:
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centres(nodes: DataFrame) -> dict[tuple[str, int], tuple[np.ndarray, int]]:
    """For each (label, length): centres, and the number of the first of its cells."""
    sizes = {(r.label, r.dim): r.n for r in nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    share = min(1.0, SAMPLE / max(1, total))
    bound = int(share * (1 << 30))
    # About ``SAMPLE`` rows at most, by hash.
    rows = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < bound).select("label", "dim", "embedding").toPandas()
    out, first = {}, 0
    for key in sorted(sizes):
        own = rows[(rows["label"] == key[0]) & (rows["dim"] == key[1])]
        x = normalised(np.stack(own["embedding"])) if len(own) else np.zeros((1, key[1]))
        k = max(1, min(len(x) // 4, -(-sizes[key] // CELL)))
        centres = x[np.random.default_rng(0).permutation(len(x))[:k]]
        for _ in range(6):
            near = np.concatenate([np.argmax(x[a : a + 4096] @ centres.T, 1) for a in range(0, len(x), 4096)])
            sums = np.zeros_like(centres)
            np.add.at(sums, near, x)
            norm = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(norm > 0, sums / np.maximum(norm, 1e-12), centres)
        # A dense group draws several centres: one stands for those within its range, so the group stays together.
        kept = [0]
        for i in range(1, len(centres)):
            if (centres[kept] @ centres[i]).max() < MERGE:
                kept.append(i)
        centres = centres[kept]
        out[key] = (centres, first)
        first += len(centres)
    return out


def deal(nodes: DataFrame) -> DataFrame:
    """``nodes`` (node, label, dim, copies, embedding) with the list of their ``cells``, ascending."""
    centres = fit_centres(nodes)

    def make():
        def step(batch):
            out = {n: batch.column(n) for n in batch.schema.names}
            labels, dims = batch.column("label").to_pylist(), batch.column("dim").to_pylist()
            rows = batch.column("embedding").to_pylist()
            cells = [None] * len(rows)
            groups: dict[tuple[str, int], list[int]] = {}
            for i, key in enumerate(zip(labels, dims)):
                groups.setdefault(key, []).append(i)
            for key, at in groups.items():
                own, first = centres[key]
                for part in range(0, len(at), 1024):
                    some = at[part : part + 1024]
                    near = normalised([rows[i] for i in some]) @ own.T
                    two = min(2, len(own))
                    second = np.partition(near, len(own) - two, 1)[:, len(own) - two]
                    joined = near >= np.minimum(second, near.max(1) - MARGIN)[:, None]
                    for i, row in zip(some, joined):
                        cells[i] = (np.flatnonzero(row) + first).tolist()
            return out | {"cells": cells}

        return step

    schema = "node long, label string, dim int, copies long, embedding array<double>, cells array<long>"
    return map_batches(nodes.select("node", "label", "dim", "copies", "embedding"), schema, make)


def prune(x: np.ndarray) -> list[np.ndarray]:
    """Robust-pruned neighbours of each row of ``x`` (unit vectors): its nearest and some spread ones as candidates.

    The very nearest stay in any case: in a dense group around one vector, pruning alone would leave that one only.
    """
    m = len(x)
    if m == 1:
        return [np.zeros(0, np.int64)]
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    k = min(CANDIDATES, m - 1)
    near = np.argpartition(-sims, k - 1, 1)[:, :k]
    spread = np.random.default_rng(m).integers(0, m, (m, 6))
    cand = np.concatenate([near, spread], 1)
    own = np.take_along_axis(sims, cand, 1)
    order = np.argsort(-own, 1, kind="stable")
    cand, own = np.take_along_axis(cand, order, 1), np.take_along_axis(own, order, 1)
    gap = 1 - own
    alive = own > -2
    alive[:, 1:] &= cand[:, 1:] != cand[:, :-1]
    kept = np.zeros_like(alive)
    for r in range(cand.shape[1]):
        take = alive[:, r] & (kept.sum(1) < DEGREE)
        if r < NEAREST:
            take = own[:, r] > -2
        kept[:, r] = take
        if r + 1 < cand.shape[1]:
            between = 1 - sims[cand[:, r][:, None], cand[:, r + 1 :]]
            between[cand[:, r][:, None] == cand[:, r + 1 :]] = 0
            alive[:, r + 1 :] &= ~(take[:, None] & (ALPHA * between <= gap[:, r + 1 :]))
    return [cand[i, kept[i]] for i in range(m)]


def medoids(x: np.ndarray, count: int = MEDOIDS) -> np.ndarray:
    """The row nearest to the mean, then rows farthest from those chosen."""
    out = [int(np.argmax(x @ x.mean(0)))]
    near = x @ x[out[0]]
    while len(out) < min(count, len(x)):
        out.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[out[-1]])
    return np.array(out)


def range_search(
    x: np.ndarray, edges: np.ndarray, queries: np.ndarray, own: np.ndarray, threshold: float = THRESHOLD
) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs found with at least about ``threshold``.

    ``edges`` (2, edges) are followed both ways, ``own`` is each query's node or -1. A query expands the ``BEAM``
    nearest nodes seen so far and all in range, until none of them is left.
    """
    m, n = len(x), len(queries)
    a, b = np.concatenate([edges, edges[::-1]], 1)
    both = np.unique(a * m + b)
    a, b = both // m, both % m
    first = np.searchsorted(a, np.arange(m + 1))
    degree = np.diff(first)
    seen = np.full((n, m), -np.inf, np.float32)
    done = np.zeros((n, m), bool)
    start = medoids(x)
    seen[:, start] = queries @ x[start].T
    mine = np.flatnonzero(own >= 0)
    seen[mine, own[mine]] = 1
    beam = min(BEAM, m)
    while True:
        least = np.partition(seen, m - beam, 1)[:, m - beam]
        least = np.minimum(least, threshold - SLACK)
        q, v = np.nonzero((seen >= least[:, None]) & ~done & (seen > -np.inf))
        if not len(q):
            break
        done[q, v] = True
        d = degree[v]
        at = np.arange(d.sum()) - np.repeat(np.cumsum(d) - d, d)
        near = b[np.repeat(first[v], d) + at]
        q = np.repeat(q, d)
        new = seen[q, near] == -np.inf
        q, near = q[new], near[new]
        if len(q):
            pair = np.unique(q * m + near)
            q, near = pair // m, pair % m
            for a in range(0, len(q), 1 << 16):
                c = slice(a, a + (1 << 16))
                seen[q[c], near[c]] = np.einsum("ij,ij->i", queries[q[c]], x[near[c]])
    return np.nonzero(seen >= threshold - 1e-4)


def _build(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("node")
    nodes = block["node"].to_numpy()
    near = prune(normalised(np.stack(block["embedding"])).astype(np.float32))
    return pd.DataFrame({"node": nodes, "near": [nodes[i] for i in near]})


def _earlier(query: pd.Series, index: pd.Series, q: np.ndarray, v: np.ndarray, cell: int) -> np.ndarray:
    """Whether the pairs (q, v) meet in a cell before ``cell`` too."""
    lists = [[np.asarray(c)[np.asarray(c) < cell] for c in side] for side in (query, index)]
    known = np.unique(np.concatenate([*lists[0], *lists[1], np.zeros(0, np.int64)]))
    one, two = (np.zeros((len(side), len(known)), bool) for side in lists)
    for side, table in zip(lists, (one, two)):
        for i, c in enumerate(side):
            table[i, np.searchsorted(known, c)] = True
    out = np.zeros(len(q), bool)
    for a in range(0, len(q), 65536):
        out[a : a + 65536] = (one[q[a : a + 65536]] & two[v[a : a + 65536]]).any(1)
    return out


def _search(threshold: float):
    def run(task: pd.DataFrame) -> pd.DataFrame:
        task = task.sort_values("node")
        index = task[task["is_index"]].reset_index(drop=True)
        query = task[task["is_query"]].reset_index(drop=True)
        empty = pd.DataFrame({"node": [], "hits": [], "root": []}).astype("int64")
        if not len(index) or not len(query):
            return empty
        x, y = normalised(np.stack(index["embedding"])), normalised(np.stack(query["embedding"]))
        place = pd.Series(np.arange(len(index)), index["node"].to_numpy())
        lists = [place.reindex(n).dropna().to_numpy(np.int64) for n in index["near"]]
        edges = np.stack([np.repeat(np.arange(len(lists)), list(map(len, lists))), np.concatenate(lists)])
        own = place.reindex(query["node"]).fillna(-1).to_numpy(np.int64)
        q, v = range_search(x.astype(np.float32), edges, y.astype(np.float32), own, threshold)
        cos = np.concatenate(
            [np.einsum("ij,ij->i", y[q[a : a + 65536]], x[v[a : a + 65536]]) for a in range(0, len(q), 65536)] or [[]]
        )
        a, b = query["node"].to_numpy()[q], index["node"].to_numpy()[v]
        keep = (cos >= threshold) & (a != b)
        q, v, a, b = q[keep], v[keep], a[keep], b[keep]
        if not len(q):
            return empty
        counts = ~_earlier(query["cells"], index["cells"], q, v, int(task["cell"].iloc[0]))
        hits = np.bincount(q[counts], index["copies"].to_numpy()[v[counts]], len(query)).astype(np.int64)
        node, root = union_find(a, b)
        roots = dict(zip(node.tolist(), root.tolist()))
        ids = query["node"].to_numpy()
        out = pd.DataFrame({"node": ids, "hits": hits, "root": [roots.get(i, i) for i in ids.tolist()]})
        extra = [i for i in node.tolist() if i not in set(ids.tolist())]
        more = pd.DataFrame({"node": extra, "hits": 0, "root": [roots[i] for i in extra]})
        out = pd.concat([out, more]) if extra else out
        return out[(out["hits"] > 0) | (out["root"] != out["node"])].astype("int64")

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label)."""
    own = vectors.select("vec_id", F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    good = own.where(usable())
    key = F.xxhash64("label", "embedding").alias("h")
    nodes = stage(
        good.groupBy(key, "label", "embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
        .withColumn("dim", F.size("embedding"))
    )
    dealt = stage(deal(nodes))
    members = dealt.withColumn("cell", F.explode("cells"))
    blocks = stage(
        members.groupBy("cell").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / BLOCK)).cast("int").alias("blocks"))
    )
    members = members.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    lists = members.select("cell", "block", "node", "embedding").groupBy("cell", "block").applyInPandas(
        _build, "node long, near array<long>"
    )
    # A node has one list for each of its cells.
    graph = stage(
        lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        .join(dealt, "node")
    )
    rows = graph.withColumn("cell", F.explode("cells"))
    rows = rows.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    each = F.sequence(F.lit(0), F.col("blocks") - 1)
    as_index = rows.withColumn("with", F.explode(each)).withColumns(
        {"of": F.col("block"), "is_index": F.lit(True), "is_query": F.col("with") == F.col("block")}
    )
    as_query = (
        rows.where("blocks > 1").withColumn("of", F.explode(each)).where("of <> block")
        .withColumns({"with": F.col("block"), "is_index": F.lit(False), "is_query": F.lit(True)})
    )
    tasks = as_index.select("cell", "of", "with", "node", "embedding", "copies", "near", "cells", "is_index", "is_query")
    tasks = tasks.unionByName(as_query.select(*tasks.columns))
    found = stage(
        tasks.groupBy("cell", "of", "with").applyInPandas(_search(threshold), "node long, hits long, root long")
    )
    hits = found.groupBy("node").agg(F.sum("hits").alias("hits"))
    joined = components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    result = stage(
        nodes.select("h", "label", "embedding", "node", "copies")
        .join(hits, "node", "left")
        .join(joined, "node", "left")
        .select(
            "h",
            F.col("label").alias("l"),
            F.col("embedding").alias("e"),
            (F.coalesce("hits", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "node").alias("component_id"),
        )
    )
    back = good.select("vec_id", "label", "embedding", key).join(
        result.withColumnRenamed("h", "k"),
        (F.col("h") == F.col("k")) & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")),
    )
    alone = own.where(~usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return back.select("vec_id", "n_links", "component_id").unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


def audit(vectors: DataFrame, result: DataFrame, queries: int = 500, threshold: float = THRESHOLD) -> float:
    """Share of the links of some vectors, found by comparing each with all vectors, that ``result`` counts.

    The queries are the usable vectors of lowest hash; their number is bounded, so they are sent to all tasks.
    """
    good = vectors.where(usable()).select("vec_id", "label", "embedding")
    rows = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(queries).collect()
    if not rows:
        return 1.0
    wanted: dict[tuple[int, int], list] = {}
    for r in rows:
        wanted.setdefault((r.label, len(r.embedding)), []).append(r)

    def make():
        ready = {k: (np.array([r.vec_id for r in v]), normalised([r.embedding for r in v])) for k, v in wanted.items()}

        def step(batch):
            out = {"vec_id": [], "n": []}
            groups: dict[tuple[int, int], list[int]] = {}
            own = batch.column("embedding").to_pylist()
            for i, label in enumerate(batch.column("label").to_pylist()):
                groups.setdefault((label, len(own[i])), []).append(i)
            for k in groups.keys() & ready.keys():
                ids, x = ready[k]
                n = (x @ normalised([own[i] for i in groups[k]]).T >= threshold).sum(1)
                out["vec_id"] += ids.tolist()
                out["n"] += n.tolist()
            return out

        return step

    truth = map_batches(good, "vec_id long, n long", make).groupBy("vec_id").agg((F.sum("n") - 1).alias("n"))
    both = truth.join(result.select("vec_id", "n_links").dropDuplicates(["vec_id"]), "vec_id")
    n, found = both.agg(F.sum("n"), F.sum(F.least("n", "n_links"))).first()
    return 1.0 if not n else found / n
