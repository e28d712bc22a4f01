"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

A document is read in passages, windows of ``width`` words that overlap by half, so that whatever an item can occupy
lies within one of them. Each passage is a query. The index keeps, for every word and block of items, the greatest
weight the word has in the block. Summed over a passage these bound the score of any item of a block; blocks that
cannot reach an item's threshold are passed over for all passages at once, and the passages left run block-max WAND
over the postings of the blocks left. An item's threshold is the least score of a passage that holds the wanted share
of its shingles, so retrieval loses none of those.

Retrieved pairs are verified on the passage: the share of the item's five-word shingles found, of its question's
(all but the last sentence) and of its answer's words (the last sentence). A pair is contaminated where the item's
share reaches 0.8 and the answer's half.

The index of ``SHARD_ITEMS`` items is sent to the tasks; more items make more such indexes, each read against all
documents. Null and empty texts, and items without words, match nothing. An item of fewer than five words matches only
texts that are nothing but the item: inside a longer text so few words are no sign of a leak.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pensio.llm.common import Words, map_batches

SHINGLE = 5
PERCENT = 80  # in whole numbers, as 1 - 0.8 is less than a fifth
SIMILARITY = PERCENT / 100
ANSWER = 0.5
SHARD_ITEMS = 2000
BLOCK = 8
COMMON = 0.03  # words in more than this share of the items are not essential
K1, B = 1.2, 0.75
_SENTENCE = re.compile(r"(?<=[.!?])\s+(?=\S)")


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: an item's last sentence is its answer; one alone is both."""
    parts = _SENTENCE.split(text.strip())
    return (text, text) if len(parts) < 2 else (" ".join(parts[:-1]), parts[-1])


class Index:
    """Impacts of words in items, by word and block, with postings for the items that may match."""

    def __init__(self, items: list[tuple[int, str]], average: float, documents: dict[int, int], count: int):
        items = [(i, t) for i, t in items if t and t.strip()]
        texts = pa.array([t for _, t in items], pa.string())
        words = Words(texts)
        self.ids = np.array([i for i, _ in items], np.int64)
        n = len(items)
        size = np.diff(words.first)
        self.terms = np.unique(words.hash)
        term = np.searchsorted(self.terms, words.hash)
        tf = np.zeros((len(self.terms), n), np.float32)
        np.add.at(tf, (term, words.row), 1)
        df = np.array([documents.get(int(h), 0) for h in self.terms.view(np.int64)], float)
        idf = np.log1p((count - df + 0.5) / (df + 0.5))
        self.impact = (
            idf[:, None] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / max(average, 1e-9)))
        ).astype(np.float32)
        self.blocks = -(-n // BLOCK) if n else 0
        padded = np.zeros((len(self.terms) + 1, self.blocks * BLOCK), np.float32)  # the last row: no word of the index
        padded[:-1, :n] = self.impact
        self.bounds = padded.reshape(len(padded), self.blocks, BLOCK).max(2)
        self.longest = int(size.max(initial=0))
        # The heaviest words that may be missing while the wanted share of shingles is there.
        self.least = np.zeros(n)
        for i in range(n):
            own = self.impact[np.unique(term[words.first[i] : words.first[i + 1]]), i]
            shingles = max(1, int(size[i]) - SHINGLE + 1)
            missing = shingles - -(-PERCENT * shingles // 100)
            self.least[i] = own.sum() - np.sort(own)[::-1][:missing].sum()
        blocked = np.full(self.blocks * BLOCK, np.inf)
        blocked[:n] = self.least
        self.block_least = blocked.reshape(-1, BLOCK).min(1) * (1 - 1e-5)
        self.least *= 1 - 1e-5
        # Words of many items are not essential: an item's threshold less all of them is left to its rare words.
        self.rare = np.append((self.impact > 0).sum(1) <= max(1, COMMON * n), False)
        common = np.where(self.rare[:-1, None], 0, self.impact).sum(0)
        left = np.full(self.blocks * BLOCK, np.inf)
        left[:n] = self.least - common
        self.block_left = left.reshape(-1, BLOCK).min(1) - 1e-3
        rows, h = words.sets(SHINGLE)
        self.shingles = [h[rows == i] for i in range(n)]
        halves = [split_item(t) for _, t in items]
        question = Words(pa.array([q for q, _ in halves], pa.string()))
        rows, h = question.sets(SHINGLE)
        self.questions = [h[rows == i] for i in range(n)]
        answer = Words(pa.array([a for _, a in halves], pa.string()))
        self.answers = [np.unique(answer.hash[answer.first[i] : answer.first[i + 1]]) for i in range(n)]
        self.postings = [np.flatnonzero(self.impact[t]) for t in range(len(self.terms))]

    @property
    def width(self) -> int:
        """Twice what the longest item occupies, and even."""
        return 2 * max(32, self.longest + self.longest // 4)

    def retrieve(self, terms: np.ndarray, allowed: np.ndarray) -> list[tuple[int, float]]:
        """Block-max WAND: items of the allowed blocks whose score over ``terms`` reaches their threshold."""
        allowed = allowed & (self.bounds[terms].sum(0) >= self.block_least)
        if not allowed.any():
            return []
        lists = [(t, p) for t in terms for p in (self.postings[t][allowed[self.postings[t] // BLOCK]],) if len(p)]
        at = [0] * len(lists)
        out = []
        while True:
            live = sorted((int(p[at[k]]), k) for k, (_, p) in enumerate(lists) if at[k] < len(p))
            if not live:
                return out
            item = live[0][0]
            block = item // BLOCK
            ends = (block + 1) * BLOCK
            # Bound of the block over the lists that still reach into it.
            inside = [k for d, k in live if d < ends]
            bound = float(self.bounds[[lists[k][0] for k in inside], block].sum())
            if bound < self.block_least[block]:
                for k in inside:
                    at[k] = int(np.searchsorted(lists[k][1], ends))
                continue
            here = [k for d, k in live if d == item]
            score = float(self.impact[[lists[k][0] for k in here], item].sum())
            if score >= self.least[item]:
                out.append((item, score))
            for k in here:
                at[k] += 1

    def _bounds(self, words: Words, terms: np.ndarray, wanted: np.ndarray, row: np.ndarray, start: np.ndarray):
        """For each passage and block, the sum of the block's greatest weights of the wanted words."""
        sums = np.zeros((len(start), self.blocks), np.float32)
        known = np.flatnonzero(wanted[terms])
        if len(known):
            group = np.searchsorted(start, known, "right") - 1
            # Words of one half passage lie together.
            firsts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            for a in range(0, len(firsts), 2048):
                part = firsts[a : a + 2048]
                end = firsts[a + 2048] if a + 2048 < len(firsts) else len(known)
                sums[group[part]] = np.add.reduceat(self.bounds[terms[known[part[0] : end]]], part - part[0], 0)
        both = sums.copy()
        follows = row[1:] == row[:-1]
        both[:-1][follows] += sums[1:][follows]
        return both

    def search(self, words: Words):
        """(row, item, first word, score, overlap, question's, answer's) of the pairs that hold."""
        terms = np.searchsorted(self.terms, words.hash)
        terms = np.where(self.terms[np.minimum(terms, len(self.terms) - 1)] == words.hash, terms, len(self.terms))
        half = self.width // 2
        # Half passages of each text: a passage is one and the next.
        sizes = np.diff(words.first)
        halves = np.maximum(1, -(-sizes // half))
        halves[sizes == 0] = 0
        row = np.repeat(np.arange(len(sizes)), halves)
        number = np.arange(len(row)) - np.repeat(np.cumsum(halves) - halves, halves)
        start = words.first[row] + number * half
        stop = np.minimum(start + half, words.first[row + 1])
        if not len(start):
            return []
        # Only rare words are looked at to begin with; where they alone cannot rule a block out, all words are.
        open_ = self.block_left <= 0
        both = self._bounds(words, terms, self.rare, row, start)
        hopeful = (both >= self.block_left) & ((both > 0) | open_)
        if open_.any():
            whole = self._bounds(words, terms, np.append(np.ones(len(self.terms), bool), False), row, start)
            hopeful &= whole >= self.block_least
        follows = np.concatenate([row[1:] == row[:-1], [False]])
        hopeful[~follows & np.concatenate([[False], row[1:] == row[:-1]])] = False  # part of the passage before
        found = {}
        for g in np.flatnonzero(hopeful.any(1)):
            a, b = start[g], stop[g + 1] if follows[g] else stop[g]
            own = np.unique(terms[a:b])
            own = own[own < len(self.terms)]
            items = self.retrieve(own, hopeful[g])
            if not items:
                continue
            passage = _shingles(words, a, b)
            tokens = words.hash[a:b]
            for item, score in items:
                overlap = float(np.isin(self.shingles[item], passage).mean())
                answer = float(np.isin(self.answers[item], tokens).mean())
                if overlap >= SIMILARITY and answer >= ANSWER:
                    question = float(np.isin(self.questions[item], passage).mean())
                    key = (int(row[g]), item)
                    if key not in found or (score, overlap) > (found[key][1], found[key][2]):
                        found[key] = (int(a - words.first[row[g]]), score, overlap, question, answer)
        return [(*k, *v) for k, v in sorted(found.items())]


def _shingles(words: Words, a: int, b: int) -> np.ndarray:
    """Five-word shingles of a stretch of words, and the whole stretch where it is shorter."""
    part = Words.__new__(Words)
    part.hash, part.row = words.hash[a:b], np.zeros(b - a, np.int64)
    part.first = np.array([0, b - a])
    return np.unique(part.shingles(SHINGLE)[1])


def indexes(benchmark: DataFrame) -> list[Index]:
    """Indexes of at most ``SHARD_ITEMS`` items each over ``benchmark`` (item_id, text); repeated items count once."""
    items = sorted({(r.item_id, r.text) for r in benchmark.where("item_id is not null").select("item_id", "text").toLocalIterator() if r.text})
    counts: dict[int, int] = {}
    total = 0
    for at in range(0, len(items), SHARD_ITEMS):
        words = Words(pa.array([t for _, t in items[at : at + SHARD_ITEMS]], pa.string()))
        total += len(words.hash)
        pairs = np.unique(np.stack([words.row, words.hash.view(np.int64)], 1), axis=0)
        for h, n in zip(*np.unique(pairs[:, 1], return_counts=True)):
            counts[int(h)] = counts.get(int(h), 0) + int(n)
    average = total / max(1, len(items))
    shards = [items[at : at + SHARD_ITEMS] for at in range(0, len(items), SHARD_ITEMS)]
    return [i for i in (Index(s, average, counts, len(items)) for s in shards) if len(i.ids)]


SCHEMA = "doc_id long, item_id long, first_word long, bm25 double, overlap double, question double, answer double"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item it holds, by the passage that scores highest.

    Repeated document rows give repeated result rows.
    """
    out = None
    for index in indexes(benchmark):

        def make(index=index):
            def step(batch):
                found = index.search(Words(batch.column("text")))
                ids = batch.column("doc_id").to_pylist()
                return {
                    "doc_id": [ids[f[0]] for f in found],
                    "item_id": [int(index.ids[f[1]]) for f in found],
                    **{n: [f[k] for f in found] for k, n in enumerate(("first_word", "bm25", "overlap", "question", "answer"), 2)},
                }

            return step

        part = map_batches(docs.select("doc_id", "text"), SCHEMA, make)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a test item. A row is judged by its own text."""
    out = docs
    for index in indexes(benchmark):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

        def make(index=index):
            def step(batch):
                bad = {f[0] for f in index.search(Words(batch.column("text")))}
                keep = pa.array([i for i in range(batch.num_rows) if i not in bad], pa.int64())
                return {n: batch.column(n).take(keep) for n in batch.schema.names}

            return step

        out = map_batches(out, schema, make)
    return out
