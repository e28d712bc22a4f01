"""Quality by importance resampling: documents are weighed by target over raw hashed n-gram models.

Both models are bags of n-grams hashed into a fixed number of buckets: words, word pairs, the shapes of words (case,
digits, marks, repetition of the word before) and pairs of shapes. The raw model counts all documents, the target model
a bounded sample of documents labelled good. A document's weight is the sum of log ratios over its n-grams. Gumbel
noise, fixed by doc_id, is added to the weight and the k highest keys are selected: a sample without replacement in
proportion to the weights.

``k`` is the number of documents whose weight reaches the border that best parts the labelled good and bad documents,
so what is as good as the target stays. A document without words weighs nothing and is never selected. A document
is known by doc_id: repeated rows share their noise and are selected together as far as k reaches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pensio.llm.common import Words, bounded, give_back, map_batches, mix, stage, _parts

BUCKETS = 1 << 14  # of each of the four kinds of n-gram
LABELLED = 20_000  # labelled documents of each class, at most
_KINDS = 4
_CLASS = np.full(256, 1, np.uint8)  # 1 letters, 2 capitals, 3 digits, 4 marks
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every n-gram; the kinds have buckets of their own."""
    kinds = _CLASS[words.data]
    counts = []
    for k in (1, 2, 3, 4):
        sums = np.zeros(len(kinds) + 1, np.int64)
        np.cumsum(kinds == k, out=sums[1:])
        counts.append(sums[words.end] - sums[words.start])
    small, capital, digit, mark = (np.minimum(c, 4) for c in counts)
    n = len(words.hash)
    same = np.zeros(n, bool)
    near = words.row[1:] == words.row[:-1]
    same[1:] = near & (words.hash[1:] == words.hash[:-1])
    final = np.where(mark > 0, words.data[words.end - 1] if n else 0, 0).astype(np.uint64)
    shape = (np.minimum(small, 1) + 2 * np.minimum(capital, 2) + 6 * np.minimum(digit, 2)).astype(np.uint64)
    shape = mix(shape + np.uint64(18) * mark.astype(np.uint64) + np.uint64(90) * same + np.uint64(180) * final)
    pair = np.flatnonzero(near)
    buckets = [words.hash, mix(words.hash[pair] + mix(words.hash[pair + 1])), shape, mix(shape[pair] + mix(shape[pair + 1]))]
    rows = [words.row, words.row[pair], words.row, words.row[pair]]
    at = [(b % np.uint64(BUCKETS)).astype(np.int64) + k * BUCKETS for k, b in enumerate(buckets)]
    return np.concatenate(rows), np.concatenate(at)


def _labelled(labels: DataFrame, quality: int, limit: int) -> np.ndarray:
    """doc_ids of a class, at most ``limit``: those that hash lowest."""
    own = labels.where((F.col("quality") == quality) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return np.array(sorted(r[0] for r in own.orderBy(F.xxhash64("doc_id")).limit(limit).collect()), np.int64)


def _is_in(ids: pa.Array, wanted: np.ndarray) -> np.ndarray:
    own = ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
    return np.isin(own, wanted) if len(wanted) else np.zeros(len(own), bool)


class Model:
    """Log ratios by bucket and the border between good and bad weights."""

    def __init__(self, raw: np.ndarray, target: np.ndarray):
        self.ratios = np.zeros(_KINDS * BUCKETS)
        for k in range(_KINDS):
            own = slice(k * BUCKETS, (k + 1) * BUCKETS)
            a, b = target[own] + 0.5, raw[own] + 0.5
            self.ratios[own] = np.log(a / a.sum()) - np.log(b / b.sum())


def fit(docs: DataFrame, good: np.ndarray) -> Model:
    """Counts all of ``docs`` for the raw model, and those in ``good`` for the target model."""

    def run(batches):
        raw, target = np.zeros(_KINDS * BUCKETS, np.int64), np.zeros(_KINDS * BUCKETS, np.int64)
        for batch in batches:
            for part in _parts(batch):
                rows, at = features(Words(part.column("text")))
                raw += np.bincount(at, minlength=len(raw))
                target += np.bincount(at[_is_in(part.column("doc_id"), good)[rows]], minlength=len(raw))
        batch = part = rows = at = None
        give_back()
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"]
        )

    counted = bounded(docs.select("doc_id", "text")).mapInArrow(run, "bucket int, raw long, target long")
    # At most as many rows as there are buckets.
    sums = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(_KINDS * BUCKETS), np.zeros(_KINDS * BUCKETS)
    raw[sums["bucket"]], target[sums["bucket"]] = sums["raw"], sums["target"]
    return Model(raw, target)


def weigh(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_words, log_weight) for every row."""

    def make():
        def step(batch):
            words = Words(batch.column("text"))
            rows, at = features(words)
            return {
                "doc_id": batch.column("doc_id"),
                "n_words": np.diff(words.first),
                "log_weight": np.bincount(rows, model.ratios[at], batch.num_rows),
            }

        return step

    return map_batches(docs.select("doc_id", "text"), "doc_id long, n_words long, log_weight double", make)


def border(weights: DataFrame, good: np.ndarray, bad: np.ndarray) -> float:
    """The weight that parts good from bad documents with the fewest errors, each class counting as much.

    Without bad documents no weight is too low. Between two neighbours the middle is taken.
    """
    ids = weights.sparkSession.createDataFrame(
        [(int(i), y) for y, own in ((1, good), (0, bad)) for i in own], "doc_id long, label int"
    )
    rows = weights.where("n_words > 0").join(F.broadcast(ids), "doc_id").select("label", "log_weight").toPandas()
    y, w = rows["label"].to_numpy(), rows["log_weight"].to_numpy()
    if not (y == 0).any() or not (y == 1).any():
        return -np.inf
    order = np.argsort(w, kind="stable")
    y, w = y[order], w[order]
    lost = np.concatenate([[0], np.cumsum(y)]) / y.sum()  # good documents below the cut
    kept = 1 - np.concatenate([[0], np.cumsum(1 - y)]) / (1 - y).sum()  # bad ones above it
    edges = np.concatenate([[True], w[1:] > w[:-1], [True]])
    cut = int(np.flatnonzero(edges)[np.argmin((lost + kept)[edges])])
    if cut == 0:
        return -np.inf
    return float((w[cut - 1] + w[cut]) / 2) if cut < len(w) else np.inf


def gumbel(doc_id: str = "doc_id", seed: int = 42) -> Column:
    """Standard Gumbel noise fixed by the document."""
    u = (F.pmod(F.xxhash64(F.col(doc_id), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def top_k(df: DataFrame, key: str, k: int, ties: list[str], steps: int = 1 << 16) -> DataFrame:
    """``df`` with ``selected`` true for the ``k`` highest keys, ties by the columns ``ties`` ascending.

    Counts over equal steps between the lowest and highest key name the step the border lies in; only that one is
    counted again in finer steps. What is left of it is ranked. NULL keys are never selected.
    """
    some = df.where(F.col(key).isNotNull())
    low, high, n = some.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    if k <= 0 or not n:
        return df.withColumn("selected", F.lit(False))
    if k >= n:
        return df.withColumn("selected", F.col(key).isNotNull())
    above = 0  # keys over ``high``, all selected
    for _ in range(3):
        width = (high - low) / steps
        if width <= 0 or low + width == low:
            break
        inside = some.where((F.col(key) >= low) & (F.col(key) <= high))
        at = F.floor((F.col(key) - low) / width)
        counts = sorted(
            ((r.lo, r.hi, r.n) for r in inside.groupBy(at).agg(
                F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")).collect()),
            reverse=True,
        )
        for lo, hi, count in counts:
            if above + count >= k:
                low, high = lo, hi
                break
            above += count
        if above + count == k or count <= 10_000:
            break
    band = F.col(key).between(low, high)
    edge = some.where(band).orderBy(F.col(key).desc(), *ties).limit(k - above).select(key, *ties)
    last = edge.orderBy(F.col(key), *[F.col(t).desc() for t in ties]).first()
    over = F.col(key) > last[0]
    equal = F.col(key) == last[0]
    kinds = dict(df.dtypes)
    place = F.struct(*[F.col(t) for t in ties]) <= F.struct(*[F.lit(last[t]).cast(kinds[t]).alias(t) for t in ties])
    return df.withColumn("selected", F.coalesce(over | (equal & place), F.lit(False)))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 42) -> DataFrame:
    """(doc_id, n_words, log_weight, gumbel_key, selected) for every row of ``docs``."""
    good, bad = _labelled(labels, 1, LABELLED), _labelled(labels, 0, LABELLED)
    # The target model never sees the good documents that the border is set by.
    held = np.arange(len(good)) % 4 == 3
    weights = stage(weigh(docs, fit(docs, good[~held])))
    if k is None:
        least = border(weights, good[held], bad)
        k = weights.where((F.col("n_words") > 0) & (F.col("log_weight") >= F.lit(least))).count()
    key = F.when(F.col("n_words") > 0, F.col("log_weight") + gumbel(seed=seed))
    return top_k(weights.withColumn("gumbel_key", key), "gumbel_key", k, ["doc_id"])
