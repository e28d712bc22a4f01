"""Periodic runs: stretches of words that repeat with a period, found by seeds on diagonals that are then extended.

A run with smallest period q is a stretch of at least ``MIN_WORDS`` words and ``REPEATS`` periods in which words q apart
are identical and which no neighbouring word continues. So at lag q at least max(MIN_WORDS, REPEATS * q) - q words in a
row meet their like; the smallest such overlap, 5, is the length of the seeds.

1. Index: the k-grams of a text, k = 5, 10, 20 and so on, each made of two of the size before; a k-gram that occurs
   once ends there, so the long ones are few.
2. Pairs: the k-grams find the lags above k / 2 up to k (the first size all up to 5). There k is at most the guaranteed
   overlap and at least the lag, so inside a run a k-gram returns after exactly one period: it is enough to pair an
   occurrence with the next one of its text, and a k-gram with very many occurrences gives as many pairs, not their
   square. A pair whose lag is no smallest period, or belongs to another size, is no seed.
3. Extend: a seed is extended to both sides word by word. A table by lag holds how far the diagonal is covered; seeds
   before that place are skipped. Seeds in a row too few for the guaranteed overlap are no run and are left out before.

Words are maximal runs without ASCII white space, told apart exactly (case counts). A null, empty or blank text has no
runs. Repeated rows give repeated results, other columns are not looked at. A long text is split into words in
stretches and held as one number a word.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame

from pensio.llm.common import crc32_of, map_batches, mix

MIN_WORDS = 6
REPEATS = 4
STRETCH = 1 << 20  # bytes split into words, and words joined, at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def overlap(lag: int) -> int:
    """Words in a row that meet their like at this lag in any run of it."""
    return max(MIN_WORDS, REPEATS * lag) - lag


SEED = min(overlap(q) for q in range(1, MIN_WORDS + 1))


def word_numbers(text: bytes, book: dict[bytes, int]) -> np.ndarray:
    """The words of a text as numbers; ``book`` gives each new word the next one."""
    out, at = [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + STRETCH)
        to = cut.start() if cut else len(text)
        out.append(np.array([book.setdefault(w, len(book)) for w in text[at:to].split()], np.int64))
        at = to
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def seeds(words: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, lag, k) of the k-grams whose next occurrence in their text lies at a lag that k is meant for.

    ``words`` are those of several texts; ``first`` and ``stop`` hold, for each word, where its text starts and ends.
    """
    n = len(words)
    one = mix((words.astype(np.uint64) + np.uint64(1)) * _FACTOR + mix(first.astype(np.uint64) + np.uint64(1)))
    gram, k, low = np.zeros(n, np.uint64), SEED, 0
    for i in range(min(SEED, n)):
        gram[: n - i] = mix(gram[: n - i] * _FACTOR + one[i:])
    at = np.flatnonzero(np.arange(n) + k <= stop)
    places, lags, sizes = [], [], []
    while len(at):
        order = at[np.argsort(gram[at], kind="stable")]
        same = gram[order[1:]] == gram[order[:-1]]
        here, there = order[:-1][same], order[1:][same]
        lag = there - here
        meant = (lag > low) & (lag <= k)
        places.append(here[meant])
        lags.append(lag[meant])
        sizes.append(np.full(int(meant.sum()), k))
        again = np.zeros(n, bool)
        again[here] = again[there] = True
        low = k
        at = np.flatnonzero(again)
        at = at[(at + 2 * k <= stop[at]) & (stop[at] - first[at] >= REPEATS * (low + 1))]
        at = at[again[at + k]]
        longer = np.zeros(n, np.uint64)
        longer[at] = mix(gram[at] * _FACTOR + gram[at + k])
        gram, k = longer, 2 * k
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) if x else empty for x in (places, lags, sizes))


def _same_right(words: np.ndarray, at: int, lag: int, stop: int) -> int:
    """The first place from ``at`` on whose word differs from that ``lag`` later, or has none within the text."""
    step = 64
    while at + lag < stop:
        to = min(at + step, stop - lag)
        other = words[at:to] != words[at + lag : to + lag]
        if other.any():
            return at + int(other.argmax())
        at, step = to, step * 2
    return at


def _same_left(words: np.ndarray, at: int, lag: int, first: int) -> int:
    """The first place of the stretch before ``at`` in which words meet their like."""
    step = 64
    while at > first:
        to = max(at - step, first)
        other = words[to:at] != words[to + lag : at + lag]
        if other.any():
            return to + len(other) - int(other[::-1].argmax())
        at, step = to, step * 2
    return at


def runs(words: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, length, period) of the runs of several texts, by place and then period; see ``seeds``."""
    place, lag, size = seeds(words, first, stop)
    order = np.lexsort((place, lag))
    place, lag, size = place[order], lag[order], size[order]
    new = np.ones(len(place), bool)
    new[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
    head = np.flatnonzero(new)
    many = np.diff(np.append(head, len(place)))
    q = lag[head]
    enough = many - 1 + size[head] >= np.maximum(MIN_WORDS, REPEATS * q) - q
    covered: dict[int, int] = {}
    found = []
    for at, q in zip(place[head[enough]].tolist(), q[enough].tolist()):
        if at < covered.get(q, 0):
            continue
        left = _same_left(words, at, q, int(first[at]))
        right = _same_right(words, at, q, int(stop[at]))
        covered[q] = right
        if right - left >= overlap(q):
            found.append((left, right - left + q, q))
    found.sort(key=lambda r: (r[0], r[2]))
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


class Batch:
    """The texts of a batch as word numbers, with their runs.

    ``first`` holds where each text starts among ``words`` and, at the end, their number; ``of`` where each text's runs
    start in ``place``, ``length`` and ``period``; places count from the text's own first word.
    """

    def __init__(self, texts: list, rewrite=None):
        """``rewrite`` may turn (row, number of words) into an order in which the row's words are taken."""
        book: dict[bytes, int] = {}
        parts = []
        for row, text in enumerate(texts):
            part = word_numbers((text or "").encode(), book)
            order = rewrite(row, len(part)) if rewrite else None
            parts.append(part if order is None else part[order])
        self.names = list(book)
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        counts = np.array([len(p) for p in parts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        place, self.length, self.period = runs(
            self.words, np.repeat(self.first[:-1], counts), np.repeat(self.first[1:], counts)
        )
        self.row = np.searchsorted(self.first, place, "right") - 1
        self.place = place - self.first[self.row]
        self.of = np.searchsorted(self.row, np.arange(len(texts) + 1))

    def collapsed(self, row: int):
        """The row's words without what repeats the first period of a run, in pieces to be joined by one space."""
        words = self.words[self.first[row] : self.first[row + 1]]
        a, b = self.of[row], self.of[row + 1]
        if a < b:
            keep = np.ones(len(words), bool)
            for s, n, q in zip(self.place[a:b], self.length[a:b], self.period[a:b]):
                keep[s + q : s + n] = False
            words = words[keep]
        for at in range(0, len(words), STRETCH):
            yield b" ".join([self.names[w] for w in words[at : at + STRETCH].tolist()])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, period) of every run of every text of ``docs``, counted in words from 0."""

    def make():
        def step(batch):
            found = Batch(batch.column("text").to_pylist())
            return {
                "doc_id": batch.column("doc_id").take(_indices(found.row)),
                "start": found.place,
                "length": found.length,
                "period": found.period,
            }

        return step

    return map_batches(docs.select("doc_id", "text"), "doc_id long, start long, length long, period long", make)


def collapse(docs: DataFrame) -> DataFrame:
    """``docs`` with each run cut down to its first period; such a text's words are joined by one space.

    A text without runs stays as it is, white space included.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def make():
        def step(batch):
            texts = batch.column("text").to_pylist()
            found = Batch(texts)
            for row in np.unique(found.row).tolist():
                texts[row] = b" ".join(found.collapsed(row)).decode()
            return {n: texts if n == "text" else batch.column(n) for n in batch.schema.names}

        return step

    return map_batches(docs, schema, make)


def _indices(rows: np.ndarray):
    import pyarrow as pa

    return pa.array(rows, pa.int64())


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order in which a tenth of the documents take their words, so that they end in a repeated stretch."""
    if doc_id is None or n == 0:
        return None
    g, kind = divmod(crc32_of(doc_id), 10)
    if kind:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string"
)


def digests(docs: DataFrame, rewrite=None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the number of runs, the longest one (ties: smallest start, then
    period; nulls without a run) and digests of all runs and of the collapsed text.

    ``rewrite`` may turn (doc_id, number of words) into an order in which a document's words are taken first.
    """

    def make():
        def step(batch):
            ids = batch.column("doc_id").to_pylist()
            order = rewrite and (lambda row, n: rewrite(ids[row], n))
            found = Batch(batch.column("text").to_pylist(), order)
            out = {name.split()[0]: [] for name in DIGEST.split(", ")}
            out["doc_id"] = ids
            out["n_runs"] = np.diff(found.of)
            for row in range(len(ids)):
                mine = slice(found.of[row], found.of[row + 1])
                each = list(zip(*(x[mine].tolist() for x in (found.place, found.length, found.period))))
                s, n, q = min(each, key=lambda r: (-r[1], r[0], r[2])) if each else (None, None, None)
                out["start"].append(s)
                out["length"].append(n)
                out["period"].append(q)
                out["exponent_milli"].append(1000 * n // q if each else None)
                out["runs_sha256"].append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in each).encode()).hexdigest())
                text = hashlib.sha256()
                for i, piece in enumerate(found.collapsed(row)):
                    text.update(b" " + piece if i else piece)
                out["collapsed_sha256"].append(text.hexdigest())
            return out

        return step

    return map_batches(docs.select("doc_id", "text"), DIGEST, make)
