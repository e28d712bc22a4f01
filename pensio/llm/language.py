"""Language identification by word, with spans for mixed texts.

Every word gets a score for each learned language from its character n-grams (naive Bayes over hashed 1-, 2- and
3-grams with word borders). Languages whose training texts hardly use a word's script are out for that word. A Viterbi
pass over the words, with a penalty for each switch, gives the best sequence of languages: its runs are the spans, and
the language of most letters is the document's.

Learned from a bounded sample of texts with a language. Texts that are null or have no letter are ``und``; without
training rows every text is. Equal scores go to the language that sorts first.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
from pyspark.sql import DataFrame, functions as F

from pensio.llm.common import crc32, map_batches, mix

SAMPLE_DOCUMENTS = 6000  # training documents, at most
BUCKETS = 1 << 17
PENALTY = 12.0  # nats a switch costs
SCRIPT_SHARE = 0.001  # of a language's letters, to be one of its scripts
UNDETERMINED = "und"

#: Script blocks as first code points; letters between two starts count as one script.
_STARTS = np.array(
    [0, 0x250, 0x370, 0x400, 0x530, 0x590, 0x600, 0x900, 0xE00, 0x10A0, 0x1100, 0x1E00, 0x1F00, 0x3040, 0x30A0, 0x3400]
    + [0xAC00, 0xD7B0, 0x10000]
)
_WORD = re.compile(r"\S+")

_caches: dict[str, "Words"] = {}  # of the model last used by this worker


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number and bucket of every n-gram of ``words``, and for each word a bit set of its scripts."""
    codes = np.frombuffer(("\x01" + "\x01".join(words) + "\x01").encode("utf-32-le", "surrogatepass"), np.uint32)
    border = codes == 1
    word = np.cumsum(border) - 1
    c = codes.astype(np.uint64)
    inner = ~border
    rows, keys = [word[inner]], [mix(c[inner] + np.uint64(1))]
    two = c[:-1] * np.uint64(0x110000) + c[1:] + np.uint64(1 << 45)
    rows.append(word[:-1])
    keys.append(mix(two))
    inner = ~border[1:-1]
    three = mix(two[:-1][inner] * np.uint64(0x9E3779B97F4A7C15) + c[2:][inner])
    rows.append(word[:-2][inner])
    keys.append(three)
    script = np.searchsorted(_STARTS, codes, "right") - 1
    used = np.unique(codes)
    letter = np.array([x < 0xD800 or x > 0xDFFF for x in used]) & [chr(x).isalpha() for x in used]
    is_letter = letter[np.searchsorted(used, codes)]
    sets = np.zeros(len(words), np.int64)
    np.bitwise_or.at(sets, word[is_letter], np.int64(1) << script[is_letter])
    return np.concatenate(rows), (np.concatenate(keys) % np.uint64(BUCKETS)).astype(np.int64), sets


class Model:
    """Languages, n-gram scores (bucket, language) and the scripts of each language as bit sets."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.key = uuid.uuid4().hex
        self.languages = languages
        smoothed = counts.astype(np.float64) + 0.1
        self.scores = np.log(smoothed / smoothed.sum(0, keepdims=True)).astype(np.float32)
        share = scripts / np.maximum(1, scripts.sum(0, keepdims=True))
        self.scripts = ((share >= SCRIPT_SHARE) << np.arange(len(scripts))[:, None]).sum(0)

    def words(self) -> "Words":
        if self.key not in _caches:
            _caches.clear()
            _caches[self.key] = Words(self)
        return _caches[self.key]


class Words:
    """Scores of words seen so far by this worker."""

    LIMIT = 400_000
    LIMIT_CHARS = 16_000_000

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self):
        self.at: dict[str, int] = {}
        self.chars = 0
        self.scores = np.zeros((1 << 14, len(self.model.languages)), np.float32)
        self.letters = np.zeros(1 << 14, np.int32)

    def learn(self, words: list[str]) -> None:
        row, bucket, sets = grams(words)
        scores = np.stack(
            [np.bincount(row, w, len(words)) for w in self.model.scores[bucket].T.astype(np.float64)], 1
        )
        allowed = (sets[:, None] & ~self.model.scripts[None, :]) == 0
        allowed |= ~allowed.any(1, keepdims=True)
        scores[~allowed] -= 100.0
        n = len(self.at)
        while n + len(words) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        self.scores[n : n + len(words)] = scores
        self.letters[n : n + len(words)] = [len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words]
        self.at.update(zip(words, range(n, n + len(words))))
        self.chars += sum(map(len, words))

    def know(self, texts: list[list[str]]) -> None:
        """Learns the words of several texts at once."""
        if len(self.at) > self.LIMIT or self.chars > self.LIMIT_CHARS:
            self.reset()
        at = self.at
        fresh = list(dict.fromkeys(w for words in texts for w in words if w not in at))
        for a in range(0, len(fresh), 20_000):
            self.learn(fresh[a : a + 20_000])

    def rows(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))


def viterbi(scores: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The language of each row of ``scores`` in the best sequence."""
    best = int(np.argmax(scores.sum(0, dtype=np.float64)))
    # A sequence with s switches has s + 1 stretches at most in other languages. So none is better where no stretch of
    # words gains more than half of what a switch costs.
    gain = np.cumsum(scores - scores[:, [best]], 0, dtype=np.float64)
    low = np.minimum(np.minimum.accumulate(gain, 0), 0)
    low[1:], low[0] = low[:-1].copy(), 0
    if (gain - low).max() <= penalty / 2:
        return np.full(len(scores), best)
    count = scores.shape[1]
    value, back = [0.0] * count, []
    for row in scores.tolist():
        top = max(value)
        source = value.index(top)
        switch = top - penalty
        come = [k if value[k] >= switch else source for k in range(count)]
        value = [(value[k] if value[k] >= switch else switch) + row[k] for k in range(count)]
        back.append(come)
    path = np.zeros(len(scores), np.int64)
    k = value.index(max(value))
    for t in range(len(scores) - 1, -1, -1):
        path[t] = k
        k = back[t][k]
    return path


def label(
    text: str | None, parts: list[str], words: Words, penalty: float = PENALTY
) -> tuple[str, float, list[tuple[str, int, int]]]:
    """Language, its share of the letters, and the spans (language, start, stop) of a text with words ``parts``."""
    languages = words.model.languages
    if not parts:
        return UNDETERMINED, 0.0, []
    rows = words.rows(parts)
    letters = words.letters[rows]
    some = np.flatnonzero(letters)
    if not len(some):
        return UNDETERMINED, 0.0, []
    path = viterbi(words.scores[rows[some]], penalty)
    share = np.bincount(path, letters[some], len(languages))
    best = int(np.argmax(share))
    cuts = np.flatnonzero(path[1:] != path[:-1]) + 1
    spans = [(languages[path[0]], 0, len(text))]
    if len(cuts):
        starts = [m.start() for m in _WORD.finditer(text)]
        bounds = [0, *(starts[some[c]] for c in cuts), len(text)]
        firsts = [path[0], *path[cuts]]
        spans = [(languages[k], a, b) for k, a, b in zip(firsts, bounds, bounds[1:])]
    return languages[best], float(share[best] / share.sum()), spans


def fit(train: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """Learns from ``train`` (doc_id, text, lang): of the rows with a language the ``sample`` lowest doc_id hashes."""
    order = F.xxhash64("doc_id")
    train = train.where("lang is not null and doc_id is not null")
    bound = train.select(order.alias("h")).distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if bound is None:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(_STARTS), 0)))

    def make():
        def step(batch):
            out = {"lang": [], "bucket": [], "n": []}
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if text:
                    by_lang.setdefault(lang, []).extend(w for w in text.lower().split() if any(map(str.isalpha, w)))
            for lang, words in by_lang.items():
                if words:
                    _, bucket, sets = grams(words)
                    n = np.bincount(bucket, minlength=BUCKETS + len(_STARTS))
                    n[BUCKETS:] = [((sets >> k) & 1).sum() for k in range(len(_STARTS))]
                    used = np.flatnonzero(n)
                    out["lang"] += [lang] * len(used)
                    out["bucket"] += used.tolist()
                    out["n"] += n[used].tolist()
            return out

        return step

    chosen = train.where(order <= bound).select("text", "lang")
    counted = map_batches(chosen, "lang string, bucket int, n long", make)
    # Bounded by the buckets and the languages of the sample.
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((BUCKETS + len(_STARTS), len(languages)))
    counts[rows["bucket"], rows["lang"].map(languages.index)] = rows["n"] if len(rows) else 0
    return Model(languages, counts[:BUCKETS], counts[BUCKETS:])


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """(doc_id, lang_pred, score, spans) for every row of ``docs``; ``score`` is the language's share of the letters."""

    def make():
        words = model.words()

        def step(batch):
            texts = batch.column("text").to_pylist()
            parts = [t.lower().split() if t and model.languages else [] for t in texts]
            words.know(parts)
            found = [label(t, p, words, penalty) for t, p in zip(texts, parts)]
            return {
                "doc_id": batch.column("doc_id"),
                "lang_pred": [f[0] for f in found],
                "score": [f[1] for f in found],
                "spans": [[dict(zip(("lang", "start", "stop"), s)) for s in f[2]] for f in found],
            }

        return step

    schema = "doc_id long, lang_pred string, score double, spans array<struct<lang:string,start:long,stop:long>>"
    return map_batches(docs.select("doc_id", "text"), schema, make)


def held_out_predictions(docs: DataFrame) -> DataFrame:
    """Predictions for all of ``docs`` by a model of the rows whose crc32(doc_id) mod 4 is not 2."""
    held = F.coalesce(crc32("doc_id") % 4 == 2, F.lit(False))
    model = fit(docs.where(~held).select("doc_id", "text", "lang"))
    return identify(docs, model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"), "spans"
    )
