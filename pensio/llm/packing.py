"""Best-fit packing of tokenized documents by large-item matching.

Lengths are whole numbers up to the capacity, so a packing depends only on how many pieces have each length: the plan
is made from that table, of at most ``capacity`` rows however many documents there are, and handles all pieces of a
length at once. Pieces above a third of the capacity fit at most twice into a sequence: from the longest down, each is
matched with the longest that still fits. Shorter ones then go, longest first, into the smallest gap that holds them,
and open a sequence only where there is none.

A piece learns its place from its rank among the pieces of its length. Ranks are counted in buckets of a few thousand
pieces by hash and summed over the buckets, so a length that many documents share is no single group.
"""

from __future__ import annotations

import bisect
import re
import string
import unicodedata
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from pensio.llm.common import map_batches, stage

CAPACITY = 4096
SEPARATOR = 1
BUCKET_ROWS = 2000
CACHED = 300_000  # words whose ids a task keeps, unless one batch has more
CACHED_LETTERS = 6_000_000  # and how long they are together: texts without spaces have long ones
AT_ONCE = 4000  # words that one call of the tokenizer gets

_SPECIAL = ("\u03a3", "\u0130", "<|")  # letters whose lower case is not one for one, and special tokens
# A lone mark between a letter and a space is a token sequence of its own; after another mark it would belong to that one.
_LETTER = "[a-z\u00df-\u00f6\u00f8-\u00ff\u03b1-\u03c9\u0430-\u045f]"
_LONE = [(re.compile(rf"\{m}(?<={_LETTER}\{m}) "), f" {m} ") for m in ".,"]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> Callable[[str], bytes]:
    """``texts_encoder`` of one text."""
    encode = texts_encoder(path)
    return lambda text: encode([text])[0]


def texts_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Ids of each text as little-endian unsigned 32-bit numbers, as the tokenizer file gives them without special tokens.

    The tokenizer drops white space and never joins text across it, so the parts between spaces and line ends are
    encoded one by one and remembered; only parts not seen before reach the tokenizer, those of all texts together. A full stop or comma after a
    word is a part of its own, so a word is remembered once, not once for every mark after it.
    """
    from tokenizers import Tokenizer
    from tokenizers.normalizers import Sequence

    tokenizer = Tokenizer.from_file(path)
    plain = Tokenizer.from_file(path)  # for words its normalizer would leave as they are
    plain.normalizer = Sequence([])
    last = np.zeros(tokenizer.get_vocab_size(), bool)  # ids that end a word
    for token, i in tokenizer.get_vocab().items():
        last[i] = token.endswith("</w>")
    known: dict[str, bytes] = {}
    letters = 0

    def ids(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def learn(parts: set[str]) -> None:
        # A word of letters with marks after it is the ids of the word and of the marks.
        normal = unicodedata.is_normalized("NFC", " ".join(parts))
        fresh, marked, whole = [part for part in parts if normal and part.isalpha()], {}, []
        for part in parts.difference(fresh):
            if part.isalpha() and unicodedata.is_normalized("NFC", part):
                fresh.append(part)
                continue
            word = part.rstrip(string.punctuation)
            if word.isalpha() and (normal or unicodedata.is_normalized("NFC", word)):
                marked[part] = (word, part[len(word) :])
                if word not in known and word not in parts:
                    fresh.append(word)
            else:
                whole.append(part)
        known.update((part, ids(part)) for part in whole)
        known.update((m, ids(m)) for m in {m for _, m in marked.values()} if m not in known)
        fresh = list(dict.fromkeys(fresh))
        for i in range(0, len(fresh), AT_ONCE):
            learn_words(fresh[i : i + AT_ONCE])
        known.update((part, known[word] + known[mark]) for part, (word, mark) in marked.items())

    def learn_words(words: list[str]) -> None:
        flat = plain.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        flat = np.array(flat, np.uint32)
        ends = np.flatnonzero(last[flat]) + 1
        if len(ends) == len(words):
            own, bounds = flat.tobytes(), [0, *(4 * ends).tolist()]
            known.update(zip(words, map(own.__getitem__, map(slice, bounds, bounds[1:]))))
        elif len(words) == 1:
            known[words[0]] = ids(words[0])
        else:  # one of them is not a word to the tokenizer
            half = len(words) // 2
            learn_words(words[:half])
            learn_words(words[half:])

    def split(text: str) -> list[str] | None:
        if any(x in text for x in _SPECIAL):
            return None
        text = text.lower().replace("\n", " ")
        for mark, apart in _LONE:
            text = mark.sub(apart, text)
        return text.split(" ")

    def encode(texts: list[str]) -> list[bytes]:
        nonlocal letters
        parts = [split(text) for text in texts]
        every = set().union(*[p for p in parts if p is not None])
        new = every.difference(known)
        letters += sum(map(len, new))
        if len(known) + len(new) > CACHED or letters > CACHED_LETTERS:
            known.clear()
            new = every
            letters = sum(map(len, new))
        learn(new)
        take = known.__getitem__
        return [ids(t) if p is None else b"".join(map(take, p)) for t, p in zip(texts, parts)]

    return encode


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, digest: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every document: its ids and a separator, cut only where longer than
    ``capacity``. A null text is empty. ``ids`` is little-endian unsigned 32-bit numbers; with ``digest``, their
    crc32 takes their place."""
    path = path or tokenizer_path()
    last = "ids_crc32" if digest else "ids"

    def make():
        encode = texts_encoder(path)

        def step(batch):
            out = {"doc_id": [], "piece": [], "start": [], "length": [], last: []}
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                ids += SEPARATOR.to_bytes(4, "little")
                for k, start in enumerate(range(0, len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + capacity)]
                    out["doc_id"].append(doc_id)
                    out["piece"].append(k)
                    out["start"].append(start)
                    out["length"].append(len(own) // 4)
                    out[last].append(zlib.crc32(own) if digest else own)
            return out

        return step

    kind = "ids_crc32 long" if digest else "ids binary"
    return map_batches(docs.select("doc_id", "text"), f"doc_id long, piece int, start long, length long, {kind}", make)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Places for ``counts[length]`` pieces: rows (length, first rank, pieces, sequences, first sequence, offset).

    Of such a row's pieces, number i goes to sequence ``first + i % sequences`` at ``offset + i // sequences * length``.
    """
    left = {n: c for n, c in counts.items() if c}
    rank = dict.fromkeys(left, 0)
    out, gaps, sequences = [], {}, 0  # gaps: size -> runs (first sequence, how many)
    sizes: list[int] = []

    def place(length, first, bins, times, offset):
        out.append((length, rank[length], bins * times, bins, first, offset))
        rank[length] += bins * times
        left[length] -= bins * times

    def leave(gap, first, bins):
        if gap and bins:
            if gap not in gaps:
                bisect.insort(sizes, gap)
            gaps.setdefault(gap, []).append((first, bins))

    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        while left[length]:
            # The longest that still fits beside it.
            i = bisect.bisect_right(large, min(capacity - length, length)) - 1
            while i >= 0 and not left[large[i]]:
                i -= 1
            mate = large[i] if i >= 0 else None
            if mate == length and left[length] == 1:
                i -= 1
                while i >= 0 and not left[large[i]]:
                    i -= 1
                mate = large[i] if i >= 0 else None
            bins = left[length] if mate is None else left[length] // 2 if mate == length else min(left[length], left[mate])
            place(length, sequences, bins, 1, 0)
            if mate is not None:
                place(mate, sequences, bins, 1, length)
            leave(capacity - length - (mate or 0), sequences, bins)
            sequences += bins
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            i = bisect.bisect_left(sizes, length)
            if i == len(sizes):  # no gap: open sequences
                times = capacity // length
                bins = max(1, left[length] // times)
                gap, first = capacity, sequences
                sequences += bins
                whole = bins if left[length] >= times else 0
            else:
                gap = sizes[i]
                first, bins = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(i)
                times = gap // length
                whole = min(bins, left[length] // times)
            if whole:
                place(length, first, whole, times, capacity - gap)
                leave(gap - times * length, first, whole)
            rest, at = bins - whole, first + whole
            if rest and left[length] and left[length] < times:
                some = left[length]
                place(length, at, 1, some, capacity - gap)
                leave(gap - some * length, at, 1)
                rest, at = rest - 1, at + 1
            leave(gap, at, rest)
    return out


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (doc_id, piece, length, and any more columns) with ``sequence_id`` and ``offset``.

    ``parts`` is read several times, so pass a written table. (doc_id, piece) tells its rows apart; where rows are
    repeated, each still gets a place of its own. No parts give no rows; a length is 1 to ``capacity``.
    """
    spark = parts.sparkSession
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = max(1, -(-sum(counts.values()) // BUCKET_ROWS))
    rows = [tuple(map(int, r)) for r in plan(counts, capacity)]
    places = spark.createDataFrame(
        rows, "p_length long, p_rank long, p_pieces long, p_bins long, p_first long, p_offset long"
    )
    bucketed = parts.withColumn("p_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    earlier = Window.partitionBy("length").orderBy("p_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        bucketed.groupBy("length", "p_bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "p_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("p_before"))
    )
    within = F.row_number().over(Window.partitionBy("length", "p_bucket").orderBy("doc_id", "piece")) - 1
    ranked = (
        bucketed.withColumn("p_within", within)
        .join(before, ["length", "p_bucket"])
        .withColumn("p_n", F.col("p_before") + F.col("p_within"))
    )
    i = F.col("p_n") - F.col("p_rank")
    return (
        # A few rows for each length there is, and lengths end at the capacity.
        ranked.join(
            F.broadcast(places),
            (F.col("length") == F.col("p_length"))
            & (F.col("p_n") >= F.col("p_rank"))
            & (F.col("p_n") < F.col("p_rank") + F.col("p_pieces")),
        )
        .withColumn("sequence_id", F.col("p_first") + i % F.col("p_bins"))
        .withColumn("offset", F.col("p_offset") + F.floor(i / F.col("p_bins")) * F.col("length"))
        .select(*parts.columns, "sequence_id", "offset")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the pieces of each sequence, in place. A sequence holds at most ``capacity`` ids."""
    return packed.groupBy("sequence_id").agg(
        F.expr("array_join(transform(array_sort(collect_list(struct(offset, ids))), x -> hex(x.ids)), '')").alias("h")
    ).select("sequence_id", F.unhex("h").alias("ids"))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(stage(pieces(docs, path, capacity, digest=True)), capacity)
