"""Repeated passages by MinHash banding of paragraphs.

A text is cut where a sentence-like start - a line, a word after a full stop, a capital, some words by hash - has a smaller hash of its
first words than one of the starts next to it. So the cuts follow the text itself: a passage keeps its inner cuts
wherever it stands, also in the middle of a line. What is left of ``LONG`` words or more, as texts without full stops and
capitals give it, is cut further at the words whose hashes are smallest, ``MIN_WORDS`` apart. Paragraphs of at least ``MIN_WORDS`` words get MinHash values over
their five-word shingles, combined into bands; ``bands`` finds the fewest bands that reach a recall at the threshold.

Paragraphs are worked on as shingle sets, told apart by a 64-bit hash; equal paragraphs are one set. A task sends a set
and its band keys once. The sets of a band meet the first of them, pairs are verified by exact Jaccard, and links make
first components. Sets of one band that are still in different components then meet each other: for each band, those
outside its most frequent component meet all of another one that have a shingle in common among the rarest ones, of
which two sets that link must share one. So whatever shares a band is found, however rows are batched. Components of
sets are the clusters: the first paragraph (lowest doc_id, then place) is kept, the others are removals.

Only runs of clustered paragraphs with at least ``MIN_RUN`` words are reported, so a short common line is no finding.
A document is known by doc_id, of any size; rows without doc_id take no part. Rows that repeat doc_id and text are found
once; different texts of one doc_id are read one by one. Null and empty texts have no paragraphs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pensio.llm.common import Words, characters, components, map_batches, mix, small, stage

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.99
MIN_WORDS = 8
MIN_RUN = 20
HASHED = 32  # one word in so many is a start in any case, for texts without sentences
LONG = 2 * MIN_WORDS  # paragraphs of so many words are cut further
GAP = 100  # code points of short paragraphs that a run may skip
SEEN = 1 << 18  # places in which a task remembers sets that it has sent


def bands(similarity: float = SIMILARITY, recall: float = RECALL, noise: float = 0.2, false: float = 0.2) -> tuple[int, int]:
    """(bands, rows of each): the fewest bands that find pairs of ``similarity`` with ``recall`` and pairs of
    similarity ``noise`` with a chance of at most ``false``."""
    fine = [
        (b, r)
        for b in range(1, 65)
        for r in range(1, 9)
        if 1 - (1 - similarity**r) ** b >= recall and 1 - (1 - noise**r) ** b <= false
    ]
    return min(fine)


def further(h: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Places that cut the stretches ``first`` to ``end`` of ``LONG`` words or more into ones of ``MIN_WORDS`` to
    ``LONG`` - 1 words: by rising ``h``, each place that is ``MIN_WORDS`` away from all cuts. So a cut depends on the
    words around it only."""
    size = end - first - 2 * MIN_WORDS + 1
    first, size = first[size > 0] + MIN_WORDS, size[size > 0]
    open_ = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
    part = np.repeat(np.arange(len(size)), size)
    out = []
    while len(open_):
        value, low = h[open_], np.ones(len(open_), bool)
        for k in range(1, MIN_WORDS):
            # The k-th next open place; it matters where it is near.
            near = (open_[k:] - open_[:-k] < MIN_WORDS) & (part[k:] == part[:-k])
            less = value[k:] < value[:-k]
            low[:-k] &= ~(near & less)
            low[k:] &= ~(near & ~less)
        cut, of = open_[low], part[low]
        out.append(cut)
        at = np.searchsorted(cut, open_)
        left, right = np.maximum(at - 1, 0), np.minimum(at, len(cut) - 1)
        gone = (np.abs(open_ - cut[left]) < MIN_WORDS) & (of[left] == part)
        gone |= (np.abs(open_ - cut[right]) < MIN_WORDS) & (of[right] == part)
        open_, part = open_[~gone], part[~gone]
    return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)


class Paragraphs:
    """Paragraphs of a slice of texts: first and end word, row, and number within the text (of those long enough)."""

    def __init__(self, column: pa.Array):
        words = self.words = Words(column)
        data, n = words.data, len(words.hash)
        lines = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data == 10, out=lines[1:])
        begin = np.zeros(n, bool)
        if n:
            head = data[words.start]
            after = data[np.minimum(words.start + 1, len(data) - 1)]
            begin |= (head >= 65) & (head <= 90) | (head == 0xC3) & (after >= 0x80) & (after <= 0x9E)
            tail = data[words.end - 1]
            stop = (tail == 46) | (tail == 33) | (tail == 63)
            begin[1:] |= stop[:-1]
            begin |= words.hash % np.uint64(HASHED) == 0
            # Where several words in a row look like a start, the last one is.
            begin[:-1] &= ~begin[1:] | (words.row[1:] != words.row[:-1])
            begin[1:] |= lines[words.start[1:]] > lines[words.end[:-1]]
            begin[words.first[:-1][np.diff(words.first) > 0]] = True
        at = np.flatnonzero(begin)
        if len(at):
            pad = np.concatenate([words.hash, np.zeros(3, np.uint64)])
            row = words.row[at]
            stop = words.first[row + 1]  # words of the next text do not count
            one, two = (np.where(at + k < stop, pad[at + k], np.uint64(0)) for k in (1, 2))
            h = mix(pad[at] + mix(one + mix(two)))
            edge = np.concatenate([[True], row[1:] != row[:-1]])
            last = np.concatenate([row[1:] != row[:-1], [True]])
            cut = edge.copy()
            cut[1:] |= ~edge[1:] & (h[1:] <= h[:-1])
            cut[:-1] |= ~last[:-1] & (h[:-1] <= h[1:])
            at = at[cut]
            end = np.minimum(np.concatenate([at[1:], [n]]), words.first[words.row[at] + 1])
            at = np.sort(np.concatenate([at, further(mix(words.hash + mix(pad[1 : n + 1])), at, end)]))
        row = words.row[at]
        end = np.concatenate([at[1:], [n]]) if len(at) else at
        end = np.minimum(end, words.first[row + 1])
        keep = end - at >= MIN_WORDS
        self.first, self.end, self.row = at[keep], end[keep], row[keep]
        firsts = np.searchsorted(self.row, np.arange(len(column)))
        self.number = np.arange(len(self.row)) - firsts[self.row]

    def sets(self) -> tuple[np.ndarray, np.ndarray]:
        """Paragraph and hash of the distinct five-word shingles."""
        part = Words.__new__(Words)
        part.hash = self.words.hash
        bounds = np.concatenate([self.first, self.end])
        place = np.zeros(len(part.hash) + 1, np.int64)
        np.add.at(place, bounds, np.concatenate([np.ones(len(self.first), int), -np.ones(len(self.first), int)]))
        inside = np.cumsum(place[:-1]) > 0
        own = np.flatnonzero(inside)
        part.hash = part.hash[own]
        part.row = np.searchsorted(self.first, own, "right") - 1
        part.first = np.concatenate([[0], np.cumsum(self.end - self.first)])
        return part.sets(SHINGLE)


def set_hashes(row: np.ndarray, h: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First shingle, size and hash of the set of each paragraph."""
    starts = np.searchsorted(row, np.arange(count))
    n = np.bincount(row, minlength=count)
    return starts, n, mix(np.add.reduceat(mix(h), starts) + n.astype(np.uint64))


def band_keys(row: np.ndarray, h: np.ndarray, count: int, shape: tuple[int, int]) -> np.ndarray:
    """Band keys (paragraph, band) of shingle sets given by paragraph; every paragraph has a shingle."""
    starts = np.searchsorted(row, np.arange(count))
    out = np.zeros((count, shape[0]), np.uint64)
    for b in range(shape[0]):
        key = np.full(count, b + 1, np.uint64)
        for r in range(shape[1]):
            salt = np.uint64((b * shape[1] + r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            key = mix(key + np.minimum.reduceat(mix(h ^ salt), starts))
        out[:, b] = key
    return out


class Sent:
    """Sets that a task has sent before: a set has one of ``SEEN`` places, where a later one takes over."""

    def __init__(self):
        self.sets = np.zeros(SEEN, np.uint64)

    def new(self, sets: np.ndarray) -> np.ndarray:
        """Which of the distinct ``sets`` are not known to be sent."""
        place = sets & np.uint64(SEEN - 1)
        first = self.sets[place] != sets
        self.sets[place] = sets
        return first


def meetings(docs: DataFrame, shape: tuple[int, int]) -> DataFrame:
    """(band, a, b, n, m): sets a that share a band with set b, the first of the band, and their sizes. Band is 0, and
    b is a, for the sets of several paragraphs."""

    def make():
        sent = Sent()

        def step(batch):
            own = Paragraphs(batch.column("text"))
            count = len(own.row)
            if not count:
                return None
            row, h = own.sets()
            _, n, s = set_hashes(row, h, count)
            sets, at, times = np.unique(s, return_index=True, return_counts=True)
            new = sent.new(sets)
            at = at[new]
            mine = np.zeros(count, bool)
            mine[at] = True
            number = np.cumsum(mine) - 1
            own_row = mine[row]
            keys = band_keys(number[row[own_row]], h[own_row], len(at), shape)[number[at]].T
            return {
                "key": np.concatenate([sets, keys.ravel()]),
                "s": np.concatenate([sets, np.tile(s[at], len(keys))]),
                # A set's own row has the paragraphs it was found in, below 0; that of a band the size.
                "n": np.concatenate([-times, np.tile(n[at], len(keys))]),
            }

        return step

    rows = map_batches(docs.select("text"), "key long, s long, n int", make)
    # All rows of a key lie together in one task, in order, and are read as a stream: a row a set and task.
    rows = rows.repartition("key").sortWithinPartitions("key", "s")

    def meet():
        last = None  # key, set and size of the first set of the band read last
        before = None  # the set of the row read last

        def step(batch):
            nonlocal last, before
            key, s, n = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("key", "s", "n"))
            whole, n = n < 0, n.astype(np.int64)
            found = s[whole]
            if len(found):
                again = np.concatenate([[found[0] == before], found[1:] == found[:-1]]) | (n[whole] < -1)
                before, found = found[-1], found[again]
            none = np.zeros(len(found), np.int64)
            out = [(none, found, found, none, none)]
            key, s, n = key[~whole], s[~whole], n[~whole]
            if len(key):
                new = np.concatenate([[last is None or key[0] != last[0]], key[1:] != key[:-1]])
                at = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
                head, m = s[at], n[at]
                if at[0] < 0:
                    head, m = np.where(at < 0, last[1], head), np.where(at < 0, last[2], m)
                last = (key[-1], head[-1], m[-1])
                other = s != head
                out.append(tuple(x[other] for x in (key, s, head, n, m)))
            return dict(zip(("band", "a", "b", "n", "m"), map(np.concatenate, zip(*out))))

        return step

    return map_batches(rows, "band long, a long, b long, n long, m long", meet).distinct()


def contents(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(s, h): the shingles of the sets in ``wanted`` (s)."""

    def make():
        sent = Sent()

        def step(batch):
            own = Paragraphs(batch.column("text"))
            count = len(own.row)
            if not count:
                return None
            row, h = own.sets()
            starts, n, s = set_hashes(row, h, count)
            sets, at = np.unique(s, return_index=True)
            new = sent.new(sets)
            sets, size, first = sets[new], n[at[new]], starts[at[new]]
            ends = np.cumsum(size)
            places = np.arange(size.sum()) + np.repeat(first - ends + size, size)
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            return {"s": sets, "h": pa.ListArray.from_arrays(offsets, pa.array(h[places].view(np.int64)))}

        return step

    rows = map_batches(docs.select("text"), "s long, h array<long>", make)
    return rows.join(small(wanted), "s").dropDuplicates(["s"])


def _similar(x: str, y: str, similarity: float) -> Column:
    both = F.size(F.array_intersect(x, y))
    return both >= (F.size(x) + F.size(y) - both) * similarity


def _linked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``pairs`` (a, b) whose exact Jaccard similarity is at least ``similarity``."""
    left = sets.select(F.col("s").alias("a"), F.col("h").alias("h_a"))
    right = sets.select(F.col("s").alias("b"), F.col("h").alias("h_b"))
    return pairs.join(left, "a").join(right, "b").where(_similar("h_a", "h_b", similarity)).select("a", "b")


def _rarest(sets: DataFrame, similarity: float) -> DataFrame:
    """(s, token): those shingles of each set, the rarest first, of which sets that link share one."""
    tokens = sets.select("s", F.size("h").alias("size"), F.explode("h").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("k"))
    order = F.sort_array(F.collect_list(F.struct("k", "token")))  # a paragraph has no more than LONG shingles
    listed = tokens.join(counts, "token").groupBy("s", "size").agg(order.alias("order"))
    needed = F.ceil(F.col("size") * similarity - 1e-9)
    prefix = F.slice("order", F.lit(1), (F.col("size") - needed + 1).cast("int"))
    return listed.select("s", F.explode(prefix.getField("token")).alias("token"))


def _apart(members: DataFrame, parts: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of sets that share a band and are in different components; candidates share one of their rarest
    shingles, and are verified where they meet. ``members`` has (band, s)."""
    component = parts.select(F.col("node").alias("s"), "component_id")
    rows = stage(members.join(component, "s", "left").select("band", "s", F.coalesce("component_id", "s").alias("c")))
    counts = rows.groupBy("band", "c").agg(F.count(F.lit(1)).alias("k"))
    major = stage(
        counts.groupBy("band").agg(F.max(F.struct("k", "c")).alias("m"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1").select("band", F.col("m.c").alias("major"))
    )
    # A set is in few bands. Of two sets of one band in different components, one is not of its most frequent component.
    mixed = rows.join(small(major), "band").groupBy("s", "c").agg(
        F.collect_set("band").alias("bands"), F.max(F.col("c") != F.col("major")).alias("minor")
    )
    known = stage(mixed.join(sets, "s"))
    both = stage(known.join(_rarest(known, similarity), "s"))
    x, y = both.where("minor").alias("x"), both.alias("y")
    can = F.least(F.size("x.h"), F.size("y.h")) >= F.greatest(F.size("x.h"), F.size("y.h")) * similarity
    meet = (F.col("x.c") != F.col("y.c")) & can & F.arrays_overlap("x.bands", "y.bands") & _similar("x.h", "y.h", similarity)
    pair = [F.greatest("x.s", "y.s").alias("a"), F.least("x.s", "y.s").alias("b")]
    return x.join(y, (F.col("x.token") == F.col("y.token")) & meet).select(*pair).distinct()


def clusters_of(docs: DataFrame, similarity: float, recall: float) -> DataFrame:
    """(s, c): the sets that several paragraphs of ``docs`` have, or that link with another one, and their component."""
    met = stage(meetings(docs, bands(similarity, recall)))
    different = met.where("band <> 0")
    members = stage(
        different.select("band", F.col("a").alias("s"), "n").union(different.select("band", "b", "m")).distinct()
    )
    sets = stage(contents(docs, stage(members.select("s").distinct())))
    near = F.least("n", "m") >= F.greatest("n", "m") * similarity
    links = stage(_linked(different.where(near).select("a", "b").distinct(), sets, similarity))
    parts = stage(components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    more = stage(_apart(members.drop("n"), parts, sets, similarity))
    if not more.isEmpty():
        both = links.unionByName(more)
        parts = stage(components(both.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    linked = parts.select(F.col("node").alias("s"), F.col("component_id").alias("c"))
    alone = met.where("band = 0").select(F.col("a").alias("s")).join(linked, "s", "left_anti")
    return stage(linked.unionByName(alone.withColumn("c", F.col("s"))))


def places(docs: DataFrame) -> DataFrame:
    """(s, doc_id, text_hash, paragraph, start, stop, n_words) of every paragraph; code points, stop exclusive."""

    def make():
        def step(batch):
            own = Paragraphs(batch.column("text"))
            if not len(own.row):
                return None
            words = own.words
            points = characters(words.data)
            base = points[words.offsets[own.row]]
            sums = np.zeros(len(words.hash) + 1, np.uint64)
            place = np.arange(len(words.hash)) - words.first[words.row]
            np.cumsum(mix(words.hash + place.astype(np.uint64)), out=sums[1:], dtype=np.uint64)
            texts = sums[words.first[1:]] - sums[words.first[:-1]]
            return {
                "s": set_hashes(*own.sets(), len(own.row))[2],
                "doc_id": batch.column("doc_id").to_numpy(zero_copy_only=False)[own.row],
                "text_hash": texts[own.row],
                "paragraph": own.number,
                "start": points[words.start[own.first]] - base,
                "stop": points[words.end[own.end - 1]] - base,
                "n_words": own.end - own.first,
            }

        return step

    schema = "s long, doc_id long, text_hash long, paragraph long, start long, stop long, n_words long"
    return map_batches(docs.select("doc_id", "text"), schema, make)


def repeated(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, min_run: int = MIN_RUN) -> DataFrame:
    """(doc_id, paragraph, start, stop, n_words, run_words, first_doc_id, first_paragraph, kept) of every clustered
    paragraph in a run of at least ``min_run`` words. The first paragraph of its cluster names the cluster."""
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    found = stage(places(docs).join(small(clusters_of(docs, similarity, recall)), "s").drop("s"))
    first = F.min(F.struct("doc_id", "paragraph")).alias("first")
    firsts = stage(
        found.groupBy("c").agg(first)
        .select("c", F.col("first.doc_id").alias("first_doc_id"), F.col("first.paragraph").alias("first_paragraph"))
    )
    text = ["doc_id", "text_hash"]
    along = Window.partitionBy(*text).orderBy("paragraph")
    near = (F.col("paragraph") - F.lag("paragraph").over(along) == 1) & (
        F.col("start") - F.lag("stop").over(along) <= GAP
    )
    apart = F.when(near, 0).otherwise(1)
    run = F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0))
    runs = (
        found.repartition(*text)
        .dropDuplicates([*text, "paragraph"])
        .withColumn("new", apart)
        .withColumn("run", run)
        .withColumn("run_words", F.sum("n_words").over(Window.partitionBy(*text, "run")))
        .where(F.col("run_words") >= min_run)
    )
    kept = (F.col("doc_id") == F.col("first_doc_id")) & (F.col("paragraph") == F.col("first_paragraph"))
    return runs.join(small(firsts), "c").select(
        "doc_id", "paragraph", "start", "stop", "n_words", "run_words", "first_doc_id", "first_paragraph",
        kept.alias("kept"),
    )
