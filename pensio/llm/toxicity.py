"""Toxicity: a support vector machine on a gapped subsequence kernel with Nystroem landmarks.

Words are compared by the subsequence kernel: common subsequences of three letters count, each gap letter makes them
count less, so inserted letters, stretched spellings and inflected stems stay near their word. Letters that stand alone
in a row are read as one word, and marks inside a word are ignored. Landmarks are words that tell toxic from other
labelled texts, each unlike the ones before. A sentence is described by its nearest word to each landmark; the
Nystroem map turns that into features of a linear machine trained on labelled sentences. In a toxic text only some
sentence need be toxic: the one that scores highest stands for the text, chosen anew in each training round. A text
scores as its highest sentence, as a probability fitted on the labelled texts.

Kernel values under ``NEAR`` count as zero; a bound by the longest common subsequence spares computing most of them.
Learned from a bounded sample of labelled texts. Null and empty texts have no sentence and score as one without any
near word; equal texts score equally. Without labels of both classes every score is 0.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, functions as F

from pensio.llm.common import crc32, map_batches, stage

SAMPLE_EACH = 3000  # labelled texts of each class, at most
LANDMARKS = 96
ORDER = 3  # letters of a subsequence
DECAY = 0.6  # weight of each letter a subsequence spans
NEAR = 0.5
POWER = 3  # of the kernel: a product of kernels, which tells close words from equal ones
LONG = 32  # letters; longer words are read in overlapping parts

_caches: dict[str, "Words"] = {}  # of the model last used by this worker


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of words as a padded matrix (0 beyond the end), and their numbers."""
    size = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(words), max(1, int(size.max(initial=0)))), np.uint32)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out, size


def kernel(s: np.ndarray, t: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Subsequence kernel of rows of ``s`` with rows of ``t`` (padded with 0), not normalised."""
    n, a, b = len(s), s.shape[1], t.shape[1]
    same = (s[:, :, None] == t[:, None, :]) & (s[:, :, None] > 0)
    prefix = np.ones((a + 1, b + 1, n))
    for _ in range(order - 1):
        new = np.zeros((a + 1, b + 1, n))
        for i in range(1, a + 1):
            row = np.zeros(n)
            for j in range(1, b + 1):
                row = decay * row + same[:, i - 1, j - 1] * (decay * decay) * prefix[i - 1, j - 1]
                new[i, j] = decay * new[i - 1, j] + row
        prefix = new
    return (same.transpose(1, 2, 0) * prefix[:-1, :-1]).sum((0, 1)) * decay * decay


def similarity(left: list[str], right: list[str]) -> np.ndarray:
    """Normalised kernel of ``left[i]`` with ``right[i]``; 0 where a word is shorter than the subsequences."""
    out = np.zeros(len(left))
    for at in range(0, len(left), 4096):
        s, _ = codes(left[at : at + 4096])
        t, _ = codes(right[at : at + 4096])
        norm = kernel(s, s) * kernel(t, t)
        own = np.zeros(len(s))
        good = norm > 0
        own[good] = kernel(s[good], t[good]) / np.sqrt(norm[good])
        out[at : at + 4096] = own
    return out


def common(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of every word and landmark (of at most 32 letters), bit-parallel."""
    letters = {c: i + 1 for i, c in enumerate(sorted(set("".join(landmarks))))}
    masks = np.zeros((len(letters) + 1, len(landmarks)), np.uint32)
    full = np.zeros(len(landmarks), np.uint32)
    for j, w in enumerate(landmarks):
        for i, c in enumerate(w):
            masks[letters[c], j] |= np.uint32(1 << i)
        full[j] = (1 << len(w)) - 1
    own, _ = codes(words)
    table = np.array(sorted(map(ord, letters)), np.uint32)
    at = np.searchsorted(table, own)
    at = np.where(table[np.minimum(at, len(table) - 1)] == own, at + 1, 0)
    v = np.full((len(words), len(landmarks)), 0xFFFFFFFF, np.uint32)
    for i in range(own.shape[1]):
        u = v & masks[at[:, i]]
        v = (v + u) | (v - u)
    return np.bitwise_count(~v & full)


def letters(part: str) -> str:
    return part if part.isalpha() else "".join(filter(str.isalpha, part))


def split(text: str | None) -> list[str]:
    """Lower-case parts between white space; a line end is a part that ends a sentence."""
    return text.lower().replace("\n", " . ").split() if text else []


def pieces(word: str) -> list[str]:
    return [word] if len(word) <= LONG else [word[i : i + LONG] for i in range(0, len(word) - LONG // 2, LONG // 2)]


class Words:
    """Nearness to the landmarks of parts seen by this worker.

    Each part has a number; by number, ``row`` is its row in ``near`` (0: near none), ``stop`` whether it ends a
    sentence, ``alone`` whether it is a single letter.
    """

    LIMIT = 500_000
    LIMIT_CHARS = 16_000_000

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.reset()

    def reset(self):
        self.at: dict[str, int] = {}
        self.chars = 0
        self.near = np.zeros((1, len(self.landmarks)))
        self.row, self.stop, self.alone = np.zeros(0, np.int32), np.zeros(0, bool), np.zeros(0, bool)

    def learn(self, parts: list[str]) -> None:
        first = len(self.at)
        self.at.update(zip(parts, range(first, first + len(parts))))
        self.chars += sum(map(len, parts))
        own = [letters(p) for p in parts]
        words = list(dict.fromkeys(w for w in own if len(w) >= ORDER))
        found = self.nearness(words)
        rows = dict(zip(found, range(len(self.near), len(self.near) + len(found))))
        self.near = np.vstack([self.near, *found.values()])
        self.row = np.append(self.row, np.array([rows.get(w, 0) for w in own], np.int32))
        self.stop = np.append(self.stop, np.array([p[-1] in ".!?" for p in parts], bool))
        self.alone = np.append(self.alone, np.array([len(w) == 1 for w in own], bool))

    def nearness(self, words: list[str]) -> dict[str, np.ndarray]:
        """For each word near a landmark, its nearness to each."""
        parts = sorted(((w, p) for w in words for p in pieces(w)), key=lambda x: len(x[1]))
        least = np.array([max(ORDER, -(-len(m) * 6 // 10)) for m in self.landmarks])
        found: dict[str, np.ndarray] = {}
        for k in range(0, len(parts), 8192):
            own = parts[k : k + 8192]
            i, j = np.nonzero(common([p for _, p in own], self.landmarks) >= least)
            values = similarity([own[x][1] for x in i], [self.landmarks[y] for y in j])
            for n in np.flatnonzero(values >= NEAR):
                row = found.setdefault(own[i[n]][0], np.zeros(len(self.landmarks)))
                row[j[n]] = max(row[j[n]], values[n] ** POWER)
        return found

    def know(self, parts: list[list[str]]) -> None:
        if len(self.at) > self.LIMIT or self.chars > self.LIMIT_CHARS:
            self.reset()
        at = self.at
        self.learn(list(dict.fromkeys(p for own in parts for p in own if p not in at)))

    def sentences(self, texts: list[str | None]) -> list[np.ndarray]:
        """Of each text, for each sentence with a word near a landmark, its greatest nearness to each."""
        parts = [split(t) for t in texts]
        self.know(parts)
        spelled = [(k, joined) for k, own in enumerate(parts) for joined in [self.spelled(own)] if joined]
        if spelled:
            self.know([joined for _, joined in spelled])
            if any(p not in self.at for own in parts for p in own[:1]):  # forgotten to make room
                self.know(parts)
        more = dict(spelled)
        return [self._of(own, more.get(k, [])) for k, own in enumerate(parts)]

    def spelled(self, parts: list[str]) -> list[str]:
        """Words spelled letter by letter: runs of at least three single letters."""
        if len(parts) < ORDER:
            return []
        alone = self.alone[np.fromiter(map(self.at.__getitem__, parts), np.int64, len(parts))]
        if not (alone[:-2] & alone[1:-1] & alone[2:]).any():
            return []
        runs = "".join(letters(p) if a else " " for p, a in zip(parts, alone)).split()
        return [r for r in runs if len(r) >= ORDER]

    def _of(self, parts: list[str], spelled: list[str]) -> np.ndarray:
        ids = np.fromiter(map(self.at.__getitem__, parts), np.int64, len(parts))
        row = self.row[ids]
        hits = np.flatnonzero(row)
        sentence = np.cumsum(self.stop[ids])[hits] - self.stop[ids[hits]]
        out = np.zeros((0, len(self.landmarks)))
        if len(hits):
            firsts = np.flatnonzero(np.concatenate([[True], sentence[1:] != sentence[:-1]]))
            out = np.maximum.reduceat(self.near[row[hits]], firsts, 0)
        extra = [self.near[r] for w in spelled for r in [self.row[self.at[w]]] if r]
        return np.vstack([out, *extra]) if extra else out


class Model:
    def __init__(self, landmarks: list[str], weights: np.ndarray, bias: float, slope: float, shift: float):
        self.key = uuid.uuid4().hex
        self.landmarks, self.weights, self.bias, self.slope, self.shift = landmarks, weights, bias, slope, shift

    def words(self) -> Words:
        if self.key not in _caches:
            _caches.clear()
            _caches[self.key] = Words(self.landmarks)
        return _caches[self.key]

    def score(self, sentences: np.ndarray) -> float:
        if not self.landmarks:
            return 0.0
        best = float((sentences @ self.weights).max(initial=0.0))
        return float(1 / (1 + np.exp(-np.clip(self.slope * (max(best, 0.0) + self.bias) + self.shift, -50, 50))))


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps; y is -1 or 1, cost a row's weight."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    keep = ridge * np.eye(len(w))
    keep[-1, -1] = 1e-3
    for _ in range(30):
        margin = 1 - y * (x1 @ w)
        on = margin > 0
        if not on.any():
            break
        a = x1[on] * cost[on, None]
        new = np.linalg.solve(keep + a.T @ x1[on], a.T @ y[on])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], float(w[-1])


def choose_landmarks(scored: list[str], count: int = LANDMARKS) -> list[str]:
    """The first ``count`` words of a list, leaving out those too like an earlier one."""
    out: list[str] = []
    for word in scored:
        if len(out) == count:
            break
        if ORDER < len(word) <= LONG and (not out or similarity([word] * len(out), out).max() < 0.85):
            out.append(word)
    return out


def train(landmarks: list[str], rows: list[tuple[int, float, list[list[float]]]]) -> Model:
    """A machine on (label, weight of the text, sentences near a landmark)."""
    m = len(landmarks)
    gram = similarity([a for a in landmarks for _ in landmarks], landmarks * m).reshape(m, m)
    gram = np.where(gram < NEAR, 0, gram) ** POWER
    value, vector = np.linalg.eigh(gram)
    value = np.maximum(value, 1e-2)
    nystroem = vector @ np.diag(value**-0.5) @ vector.T
    bags = [(y, c, np.array(s).reshape(-1, m) @ nystroem) for y, c, s in rows]
    negative = [(c, s) for y, c, s in bags if not y]
    positive = [(c, s) for y, c, s in bags if y and len(s)]
    if not positive or not negative:
        return Model([], np.zeros(0), 0.0, 1.0, 0.0)
    none = np.zeros((1, m))
    x0 = np.vstack([s if len(s) else none for _, s in negative])
    c0 = np.concatenate([np.full(max(1, len(s)), c) for c, s in negative])
    # To begin with, the sentence nearest to any landmark stands for a toxic text.
    witness = [s[np.argmax(np.abs(s).sum(1))] for _, s in positive]
    for _ in range(5):
        x = np.vstack([x0, witness])
        y = np.concatenate([-np.ones(len(x0)), np.ones(len(witness))])
        c = np.concatenate([c0, [c for c, _ in positive]])
        w, bias = _machine(x, y, c)
        witness = [s[np.argmax(s @ w)] for _, s in positive]
    best = np.array([max(0.0, float((s @ w).max(initial=0.0))) + bias for _, _, s in bags])
    slope, shift = _platt(best, np.array([y for y, _, _ in bags], float), np.array([c for _, c, _ in bags]))
    return Model(landmarks, nystroem @ w, bias, slope, shift)


def _platt(f: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * f + b, -50, 50)))
        h = cost * p * (1 - p) + 1e-6
        g = cost * (p - y)
        hess = np.array([[(h * f * f).sum() + 1e-3, (h * f).sum()], [(h * f).sum(), h.sum()]])
        step = np.linalg.solve(hess, [(g * f).sum() + 1e-3 * (a - 1), g.sum()])
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return max(a, 1e-3), b


def fit(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH) -> Model:
    """A model from at most ``each`` labelled texts of each class, those whose doc_ids hash lowest."""
    spark = docs.sparkSession
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows, weight = [], {}
    for y in (0, 1):
        own = known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id")).limit(each).collect()
        weight[y] = sizes.get(y, 0) / max(1, len(own))
        rows += [(r.doc_id, y) for r in own]
    chosen = F.broadcast(spark.createDataFrame(rows, "l_doc_id long, y int"))
    sample = stage(docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("l_doc_id")).select("text", "y"))

    def words():
        def step(batch):
            found: dict[tuple[str, int], int] = {}
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                for w in {w for w in map(letters, split(text)) if ORDER < len(w) <= LONG}:
                    found[w, y] = found.get((w, y), 0) + 1
            return {"word": [w for w, _ in found], "y": [y for _, y in found], "n": list(found.values())}

        return step

    counted = map_batches(sample, "word string, y int, n long", words).groupBy("word").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"),
    )
    n1, n0 = (max(1, sum(1 for _, y in rows if y == k)) for k in (1, 0))
    p, q = F.col("a") / n1, F.col("b") / n0
    gain = p * F.log((p + 0.5 / n1) / (q + 0.5 / n0))
    top = counted.where((F.col("a") >= 3) & (p > 2 * q)).orderBy(gain.desc(), "word").limit(40 * LANDMARKS)
    landmarks = choose_landmarks([r.word for r in top.collect()])
    if not landmarks:
        return Model([], np.zeros(0), 0.0, 1.0, 0.0)

    def near():
        own = Words(landmarks)

        def step(batch):
            texts, ys = batch.column("text").to_pylist(), batch.column("y").to_pylist()
            return {"y": ys, "near": [s.tolist() for s in own.sentences(texts)]}

        return step

    described = map_batches(sample, "y int, near array<array<double>>", near).collect()
    return train(landmarks, [(r.y, weight[r.y], r.near) for r in described])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""

    def make():
        words = model.words()

        def step(batch):
            texts = batch.column("text").to_pylist()
            found = words.sentences(texts) if model.landmarks else [np.zeros((0, 0))] * len(texts)
            return {"doc_id": batch.column("doc_id"), "score": [model.score(s) for s in found]}

        return step

    return map_batches(docs.select("doc_id", "text"), "doc_id long, score double", make)


def held_out_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores for all of ``docs`` by a model of the labels whose crc32(doc_id) mod 5 is not 0."""
    held = F.coalesce(crc32("doc_id") % 5 == 0, F.lit(False))
    model = fit(docs, labels.where(~held).select("doc_id", "toxic"))
    return score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
