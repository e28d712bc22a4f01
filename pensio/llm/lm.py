"""Cross-entropy difference of two matched word-bigram models.

The background model counts all documents, the target model those marked as target. Both share one vocabulary - the
words that make up at least ``WORD_SHARE`` of all words, everything else is one unknown word - and one list of bigrams,
those that make up at least ``PAIR_SHARE`` of all. So neither list can be longer than one over its share, whatever the
size of the corpus, and both are found by counting all of it. A bigram on the list has its discounted relative
frequency; the rest of the mass goes to the smoothed word model, so each model's probabilities sum to 1.

A document's score is the mean over its words of the loss under the target model less that under the background
model: below 0, the text is more like the target. Texts without words have no scores (NULL).

``whole_scores`` has the same scores from models without a limit on either list: every word and every bigram of the
corpus has its own counts, with a Dirichlet prior, p(b after a) = (n(a b) + PRIOR p(b)) / (n(a) + PRIOR), and
p(b) = (n(b) + 0.5) / (all words + 0.5 distinct words). What is left to 1 is a text that ends after a. The loss is the
sum of a term of a alone and one of the bigram, so words and bigrams that make up at least ``SENT`` of all are sent to
the texts, and all other bigrams are dealt out, counted where equal ones meet, and their losses summed up by text.
The lists sent decide where a bigram is looked up, never what it counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pensio.llm.common import Words, _BASE, _parts, bounded, crc32, give_back, map_batches, mix, small, stage

WORD_SHARE = 1e-4
PAIR_SHARE = 1e-6
DISCOUNT = 0.5
START = 1  # number of the document start; 0 is the unknown word
_SHIFT = 1 << 20
PRIOR = 4.0
SENT = 1e-6  # share of all words from which on a word or bigram is counted by list in every task
BUCKET_WORDS = 500_000
SAMPLED = 16  # one in so many documents says which bigrams to list


def word_numbers(words: Words, vocabulary: np.ndarray) -> np.ndarray:
    """Number of each word: its place in the sorted vocabulary of hashes plus 2, or 0."""
    if not len(vocabulary):
        return np.zeros(len(words.hash), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, words.hash), len(vocabulary) - 1)
    return np.where(vocabulary[at] == words.hash, at + 2, 0)


def pairs(words: Words, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word, the number of the word before it (of the start for a text's first) and its own."""
    own = word_numbers(words, vocabulary)
    before = np.empty_like(own)
    before[1:] = own[:-1]
    firsts = words.first[:-1][np.diff(words.first) > 0]
    before[firsts] = START
    return before, own


def vocabulary(docs: DataFrame, share: float = WORD_SHARE) -> np.ndarray:
    """Sorted hashes of the words that make up at least ``share`` of all words of ``docs``."""

    def make():
        def step(batch):
            hashes, n = np.unique(Words(batch.column("text")).hash, return_counts=True)
            return {"word": hashes, "n": n}

        return step

    counted = map_batches(docs.select("text"), "word long, n long", make).groupBy("word").agg(F.sum("n").alias("n"))
    counts = stage(counted)
    total = counts.agg(F.sum("n")).first()[0] or 0
    # No more rows than 1 / share.
    frequent = counts.where(F.col("n") >= F.lit(max(2.0, share * total))).select("word").toArrow()
    return np.sort(frequent.column("word").to_numpy().astype(np.int64).view(np.uint64))


class Model:
    """Sorted bigram keys and, for each model, log probabilities of listed bigrams, back-off masses and words."""

    def __init__(self, vocab: np.ndarray, keys: np.ndarray, listed: np.ndarray, contexts: np.ndarray, words: np.ndarray):
        """``listed`` (2, bigrams), ``contexts`` and ``words`` (2, numbers) are counts: target, background."""
        self.vocab, self.keys = vocab, keys
        smoothed = words + 0.5
        smoothed[:, START] = 0
        unigram = smoothed / smoothed.sum(1, keepdims=True)
        first, second = keys // _SHIFT, keys % _SHIFT
        self.listed, self.rest, self.unigram = [], [], []
        for k in (0, 1):
            total = np.maximum(contexts[k], 1e-9)
            direct = np.maximum(listed[k] - DISCOUNT, 0) / total[first]
            rest = 1 - np.bincount(first, direct, len(contexts[k]))
            rest[contexts[k] == 0] = 1
            rest = np.maximum(rest, 1e-9)
            self.listed.append(np.log(direct + rest[first] * unigram[k][second]).astype(np.float32))
            self.rest.append(np.log(rest).astype(np.float32))
            with np.errstate(divide="ignore"):
                self.unigram.append(np.log(unigram[k]).astype(np.float32))

    def losses(self, before: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Negative log probability of each word under the target and the background model."""
        out = [-(self.rest[k][before] + self.unigram[k][own]) for k in (0, 1)]
        if len(self.keys):
            key = before * _SHIFT + own
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            for k in (0, 1):
                out[k][hit] = -self.listed[k][at[hit]]
        return out[0], out[1]


def fit(docs: DataFrame, target_ids: DataFrame, word_share: float = WORD_SHARE, pair_share: float = PAIR_SHARE) -> Model:
    """Models of ``docs`` and of those of them whose doc_id is in ``target_ids`` (doc_id)."""
    vocab = vocabulary(docs, word_share)
    size = len(vocab) + 2
    ids = stage(target_ids.where("doc_id is not null").select("doc_id").distinct().withColumn("target", F.lit(True)))
    marked = docs.select("doc_id", "text").join(small(ids), "doc_id", "left").select("text", F.col("target").isNotNull().alias("target"))

    def run(batches):
        # A bigram's key, its count and its count in target texts; a context's or a word's count has a key below 0.
        for batch in batches:
            for part in _parts(batch):
                words = Words(part.column("text"))
                before, own = pairs(words, vocab)
                wanted = part.column("target").to_numpy(zero_copy_only=False)[words.row]
                keys = np.concatenate([before * _SHIFT + own, -1 - before, -1 - size - own])
                keys, at = np.unique(keys, return_inverse=True)
                n = np.bincount(at, minlength=len(keys))
                t = np.bincount(at, np.tile(wanted, 3), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, n, t)], ["k", "n", "t"])

    counts = bounded(marked).mapInArrow(run, "k long, n long, t long").groupBy("k").agg(
        F.sum("n").alias("n"), F.sum("t").alias("t")
    )
    counts = stage(counts.where("n > 1 or k < 0"))
    total = counts.where(F.col("k").between(-1 - 2 * size, -1 - size)).agg(F.sum("n")).first()[0] or 0
    # Contexts and words are as many as the vocabulary, listed bigrams no more than 1 / pair_share.
    kept = counts.where((F.col("k") < 0) | (F.col("n") >= max(2.0, pair_share * total))).toArrow()
    k, n, t = (kept.column(c).to_numpy().astype(np.int64) for c in ("k", "n", "t"))
    contexts, words = np.zeros((2, size)), np.zeros((2, size))
    both = np.stack([t, n]).astype(float)
    for out, first in ((contexts, 0), (words, size)):
        own = (k < -first) & (k >= -first - size)
        out[:, -1 - first - k[own]] = both[:, own]
    listed = np.flatnonzero(k >= 0)
    listed = listed[np.argsort(k[listed])]
    return Model(vocab, k[listed], both[:, listed], contexts, words)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_words, ce_target, ce_background, ce_difference) for every row, in nats a word."""

    def make():
        def step(batch):
            words = Words(batch.column("text"))
            target, background = model.losses(*pairs(words, model.vocab))
            n = np.diff(words.first)
            with np.errstate(invalid="ignore", divide="ignore"):
                a = np.bincount(words.row, target, batch.num_rows) / n
                b = np.bincount(words.row, background, batch.num_rows) / n
            none = n == 0
            return {
                "doc_id": batch.column("doc_id"),
                "n_words": n,
                "ce_target": pa.array(a, mask=none),
                "ce_background": pa.array(b, mask=none),
                "ce_difference": pa.array(a - b, mask=none),
            }

        return step

    schema = "doc_id long, n_words long, ce_target double, ce_background double, ce_difference double"
    return map_batches(docs.select("doc_id", "text"), schema, make)


class Listed:
    """Counts (2, n) of target and background for the words on a sorted list of hashes, and for bigrams on another."""

    def __init__(self, words, counts, totals: np.ndarray, distinct: int, keys=None, pair_counts=None):
        self.words, self.counts, self.keys, self.pair_counts = words, counts, keys, pair_counts
        self.totals, self.distinct = totals, distinct

    def base(self, k: int, n: np.ndarray) -> np.ndarray:
        """PRIOR times the probability of words that occur ``n`` times."""
        return PRIOR * (n + 0.5) / (self.totals[k] + 0.5 * self.distinct)


def _find(listed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted list, or -1."""
    if not len(listed):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(listed, values), len(listed) - 1)
    return np.where(listed[at] == values, at, -1)


def _bigrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word, the hash of the one before it (START for a text's first) and that of both."""
    before = np.empty_like(words.hash)
    before[1:] = words.hash[:-1]
    before[words.first[:-1][np.diff(words.first) > 0]] = START
    return before, mix(before * np.uint64(_BASE) + words.hash)


def _listed_words(marked: DataFrame, sent: float) -> Listed:
    def make():
        def step(batch):
            words = Words(batch.column("text"))
            target = batch.column("target").to_numpy(zero_copy_only=False)
            begun = np.flatnonzero(np.diff(words.first))
            hashes, at = np.unique(np.concatenate([words.hash, np.full(len(begun), START, np.uint64)]), return_inverse=True)
            wanted = target[np.concatenate([words.row, begun])]
            t = np.bincount(at, wanted, len(hashes)).astype(np.int64)
            return {"word": hashes, "n": np.bincount(at, minlength=len(hashes)), "t": t}

        return step

    counted = map_batches(marked.select("text", "target"), "word long, n long, t long", make)
    counted = stage(counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("t").alias("t")))
    start = F.col("word") == START
    total = counted.where(~start).agg(F.sum("t"), F.sum("n"), F.count("n")).first()
    totals, distinct = np.array([total[0] or 0, total[1] or 0], float), total[2]
    # No more rows than 1 / sent, and the start.
    kept = counted.where(start | (F.col("n") >= F.lit(max(2.0, sent * totals[1])))).toArrow()
    hashes, t, n = (kept.column(c).to_numpy() for c in ("word", "t", "n"))
    order = np.argsort(hashes.view(np.uint64))
    return Listed(hashes.view(np.uint64)[order], np.stack([t, n]).astype(float)[:, order], totals, distinct)


def _list_bigrams(marked: DataFrame, lists: Listed, sent: float) -> Listed:
    """``lists`` with bigrams whose second word is on it and that are frequent in a sample, counted over all texts."""

    def make():
        def step(batch):
            words = Words(batch.column("text"))
            _, key = _bigrams(words)
            keys, n = np.unique(key[_find(lists.words, words.hash) >= 0], return_counts=True)
            return {"k": keys, "n": n}

        return step

    some = marked.where(crc32("doc_id") % SAMPLED == 0).select("text")
    found = stage(map_batches(some, "k long, n long", make).groupBy("k").agg(F.sum("n").alias("n")))
    total = found.agg(F.sum("n")).first()[0] or 0
    listed = found.where(F.col("n") >= F.lit(max(2.0, sent * total))).select("k").toArrow()
    keys = np.sort(listed.column("k").to_numpy().view(np.uint64))

    def count(batches):
        n, t = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for batch in batches:
            for part in _parts(batch):
                words = Words(part.column("text"))
                at = _find(keys, _bigrams(words)[1])
                hit = at >= 0
                wanted = part.column("target").to_numpy(zero_copy_only=False)[words.row[hit]]
                np.add.at(n, at[hit], 1)
                np.add.at(t, at[hit][wanted], 1)
        for some in np.array_split(np.flatnonzero(n), len(n) // 100_000 + 1):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, n[some], t[some])], ["i", "n", "t"])
        give_back()

    counts = bounded(marked.select("text", "target")).mapInArrow(count, "i long, n long, t long")
    counts = counts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()
    both = np.zeros((2, len(keys)))
    i = counts.column("i").to_numpy()
    both[0, i], both[1, i] = counts.column("t").to_numpy(), counts.column("n").to_numpy()
    return Listed(lists.words, lists.counts, lists.totals, lists.distinct, keys, both)


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit numbers as compressed bytes, equal places of all numbers side by side."""
    planes = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return pa.compress(planes, "zstd", asbytes=True)


def _unpack(block: bytes, rows: int, columns: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(block, 8 * rows * columns, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(columns, 8, rows).transpose(0, 2, 1)).view(np.int64)[:, :, 0]


def _rest(marked: DataFrame, lists: Listed) -> DataFrame:
    """(doc, twin, target, background): what the words and bigrams that are not listed add to each text's losses.

    A bigram goes to a bucket by its second word where that is rare, so its own count is found there too; else by the
    bigram. There are so many buckets that each holds about ``BUCKET_WORDS`` words' bigrams whatever the corpus.
    """
    buckets = max(1, int(lists.totals[1]) // BUCKET_WORDS)

    def deal(batches):
        for batch in batches:
            own = [_unlisted(part, lists) for part in _parts(batch)]
            own = [np.concatenate(c) for c in zip(*own)]
            bucket = own[0].view(np.uint64) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            own, bucket = [c[order] for c in own], bucket[order].astype(np.int64)
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(starts[1:], len(bucket))
            for at in range(0, len(starts), 10_000):
                some = list(zip(starts[at : at + 10_000], ends[at : at + 10_000]))
                blocks = [_pack([c[i:j] for c in own]) for i, j in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[starts[at : at + 10_000]]), pa.array([j - i for i, j in some], pa.int32()), pa.array(blocks, pa.binary())],
                    ["bucket", "n", "block"],
                )
        give_back()

    def run(batches):
        at, held = None, []
        for batch in batches:
            for bucket, n, block in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at and held:
                    yield _losses(np.concatenate(held, axis=1), lists)
                    held = []
                at = bucket
                held.append(_unpack(block, n, 5))
        if held:
            yield _losses(np.concatenate(held, axis=1), lists)
        give_back()

    dealt = bounded(marked.select("text", "target", "doc", "twin")).mapInArrow(deal, "bucket long, n int, block binary")
    sums = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        run, "doc long, twin long, target double, background double"
    )
    return sums.groupBy("doc", "twin").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def _unlisted(batch: pa.RecordBatch, lists: Listed) -> list[np.ndarray]:
    """Bigrams that are not listed, one row for equal ones of a text: group, bigram (0 where it is the group), text's doc
    and twin, and in one number the second word's place, how often, whether one ends the text, and target."""
    words = Words(batch.column("text"))
    _, key = _bigrams(words)
    second = _find(lists.words, words.hash)
    left = np.flatnonzero(_find(lists.keys, key) < 0)
    order = left[np.lexsort((key[left], words.row[left]))]
    new = np.ones(len(order), bool)
    new[1:] = (words.row[order[1:]] != words.row[order[:-1]]) | (key[order[1:]] != key[order[:-1]])
    starts = np.flatnonzero(new)
    n, one = np.diff(np.append(starts, len(order))), order[new]
    rare, row = second[one] < 0, words.row[one]
    target = batch.column("target").to_numpy(zero_copy_only=False)[row]
    ends = np.zeros(len(second), np.int64)  # no word of the text comes after these
    ends[words.first[1:][np.diff(words.first) > 0] - 1] = 1
    final = np.add.reduceat(ends[order], starts) if len(order) else ends[order]
    return [
        np.where(rare, words.hash[one], key[one]).view(np.int64),
        np.where(rare, key[one], np.uint64(0)).view(np.int64),
        batch.column("doc").to_numpy()[row],
        batch.column("twin").to_numpy()[row],
        (second[one] + 1) << 40 | n << 2 | final << 1 | target,
    ]


def _losses(rows: np.ndarray, lists: Listed) -> pa.RecordBatch:
    """The losses of the bigrams of a bucket, whose groups are whole, as ``_unlisted`` gives them."""
    g, p, doc, twin, x = rows[:, np.lexsort((rows[1], rows[0]))]
    second, n, final, target = (x >> 40) - 1, x >> 2 & (1 << 38) - 1, x >> 1 & 1, x & 1
    starts = np.ones(len(g), bool)
    starts[1:] = g[1:] != g[:-1]
    own = starts.copy()
    own[1:] |= p[1:] != p[:-1]
    group, pair = np.cumsum(starts) - 1, np.cumsum(own) - 1
    rare, out = second < 0, []
    for k, weight in ((0, n * target), (1, n)):
        words = np.where(rare, np.bincount(group, weight)[group], lists.counts[k][second])
        loss = -np.log(np.bincount(pair, weight)[pair] + lists.base(k, words))
        # A rare word is also the first of a bigram wherever it does not end its text.
        out.append(n * loss + np.where(rare, (n - final) * np.log(words + PRIOR), 0))
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in (doc, twin, *out)], ["doc", "twin", "target", "background"]
    )


def _local(marked: DataFrame, lists: Listed) -> DataFrame:
    """(doc_id, doc, twin, n_words, target, background): losses of listed words and bigrams, for every row."""

    def make():
        def step(batch):
            words = Words(batch.column("text"))
            before, key = _bigrams(words)
            first, second, at = _find(lists.words, before), _find(lists.words, words.hash), _find(lists.keys, key)
            out = []
            for k in (0, 1):
                loss = np.zeros(len(first))
                known = first >= 0
                loss[known] = np.log(lists.counts[k][first[known]] + PRIOR)
                hit = at >= 0
                loss[hit] -= np.log(lists.pair_counts[k][at[hit]] + lists.base(k, lists.counts[k][second[hit]]))
                out.append(np.bincount(words.row, loss, batch.num_rows))
            return {
                "doc_id": batch.column("doc_id"), "doc": batch.column("doc"), "twin": batch.column("twin"),
                "n_words": np.diff(words.first), "target": out[0], "background": out[1],
            }

        return step

    schema = "doc_id long, doc long, twin long, n_words long, target double, background double"
    return map_batches(marked.select("doc_id", "text", "doc", "twin"), schema, make)


def whole_scores(docs: DataFrame, target_ids: DataFrame, sent: float = SENT) -> DataFrame:
    """The columns of ``score`` for every row of ``docs``, from models of all words and bigrams; the target is those
    documents whose doc_id is in ``target_ids`` (doc_id). Rows may share a doc_id or have none."""
    ids = stage(target_ids.where("doc_id is not null").select("doc_id").distinct().withColumn("target", F.lit(True)))
    repeated = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    repeated = stage(repeated.select(F.col("doc_id").alias("r"), F.lit(True).alias("several")))
    # Rows that no doc_id tells apart are told apart by text: equal texts have equal scores.
    marked = (
        docs.select("doc_id", "text")
        .join(small(ids), "doc_id", "left")
        .join(small(repeated), F.col("doc_id").eqNullSafe(F.col("r")), "left")
        .select(
            "doc_id", "text", F.col("target").isNotNull().alias("target"), F.coalesce("doc_id", F.lit(0)).alias("doc"),
            F.when(F.col("several"), F.xxhash64("text", F.col("doc_id").isNull())).otherwise(0).alias("twin"),
        )
    )
    lists = _list_bigrams(marked, _listed_words(marked, sent), sent)
    rest = _rest(marked, lists)
    copies = marked.where("twin <> 0").groupBy("doc", "twin").agg(F.count(F.lit(1)).alias("copies"))
    own = _local(marked, lists)
    if not repeated.isEmpty():
        rest = rest.join(copies, ["doc", "twin"], "left").select(
            "doc", "twin", *[(F.col(c) / F.coalesce("copies", F.lit(1))).alias(c) for c in ("target", "background")]
        )
    names = {"target": "more_target", "background": "more_background"}
    met = own.join(rest.withColumnsRenamed(names), ["doc", "twin"], "left")
    a, b = ((F.col(c) + F.coalesce(n, F.lit(0.0))) / F.col("n_words") for c, n in names.items())
    some = F.col("n_words") > 0
    return met.select(
        "doc_id", "n_words", F.when(some, a).alias("ce_target"), F.when(some, b).alias("ce_background"),
        F.when(some, a - b).alias("ce_difference"),
    )


def good_documents(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1").select("doc_id")
