"""Operators that judge each text by itself: packing, personal data, languages, toxicity, quality, language models."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pensio.llm import boosting, language, lm, packing, pii, quality, toxicity
from pensio.llm.common import crc32_of
from tests.llm.conftest import prose


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


@settings(max_examples=80, deadline=None)
@given(st.text("aB É.,!'’s \n\t<|>endoftxΣİ́日1 ", max_size=40))
def test_ids_are_those_of_the_tokenizer(text):
    own = np.frombuffer(packing.encoder(packing.tokenizer_path())(text), "<u4").tolist()
    assert own == tokenizer().encode(text, add_special_tokens=False).ids


def test_texts_of_a_batch_reach_the_tokenizer_together(monkeypatch):
    """Words of all texts go in few calls, once for all marks after them, and every text keeps its own ids."""
    import tokenizers

    real, calls = tokenizers.Tokenizer, []

    class Counted:
        def __init__(self, inner):
            self.__dict__["inner"] = inner

        @staticmethod
        def from_file(path):
            return Counted(real.from_file(path))

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def __setattr__(self, name, value):
            setattr(self.inner, name, value)

        def encode_batch_fast(self, texts, **options):
            calls.append(texts)
            return self.inner.encode_batch_fast(texts, **options)

    r = random.Random(8)
    odd = ["a?. b", "e\u0301. x", "x'. y", "it's. so", "5. a", "a5, b", "\u65e5. b", "\u1c89. a", "\ua7da b", "...", "a .b", "a. . b", "\u0301. a", "_. a", ""]
    some = ["ab", "zu", "\u00e9t\u00e9", "Ma\u00df", ".", ",", "?", "'", " ", " ", "\n", "3", "e\u0301", "\u65e5", "\t", "<|", "\u03a3"]
    texts = [*odd, *("".join(r.choice(some) for _ in range(r.randrange(12))) for _ in range(400))]
    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    own = packing.texts_encoder(packing.tokenizer_path())
    t = real.from_file(packing.tokenizer_path())
    assert [np.frombuffer(b, "<u4").tolist() for b in own(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    calls.clear()
    plain = [f"wort{c}. haus{c}, wort{c}, haus{c}. wort{c} haus{c}" for c in "abcdefghij"]
    own(plain)
    assert [sorted(c[0].split()) for c in calls] == [sorted(w + c for w in ("wort", "haus") for c in "abcdefghij")]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=12))
def test_plan_places_every_piece_once(counts):
    places = packing.plan(counts, 60)
    used, ranks = defaultdict(list), defaultdict(list)
    for length, rank, pieces, bins, first, offset in places:
        for i in range(pieces):
            ranks[length].append(rank + i)
            used[first + i % bins].append((offset + i // bins * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 60


def test_packing_round_trip(odd, none):
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    parts = packing.pieces(docs)
    packed = packing.pack(packing.stage(parts)).toPandas()
    t = tokenizer()
    for r in docs.select("doc_id", "text").collect():
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 1]
        own = packed[packed.doc_id == r.doc_id].sort_values("piece")
        assert np.frombuffer(b"".join(own["ids"]), "<u4").tolist() == ids
        assert own.start.tolist() == list(range(0, len(ids), packing.CAPACITY))
    total = packed.length.sum()
    fill = packed.groupby("sequence_id").length.sum()
    assert fill.max() <= packing.CAPACITY and len(fill) <= -(-total // packing.CAPACITY) + 1
    whole = packing.pack_documents(odd).toPandas()
    assert len(whole) == packing.pieces(odd).count()
    assert (whole.sort_values(["doc_id", "piece"]).ids_crc32 >= 0).all()
    joined = {r.sequence_id: r.ids for r in packing.sequences(packing.pack(packing.stage(parts))).collect()}
    assert {k: len(v) // 4 for k, v in joined.items()} == fill.to_dict()
    assert packing.pack_documents(none).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and total % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(BASE).index(s[0])))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a.b@c.de", "@", "+1 (234) 555-0100", "4111 1111 1111 1111", "10.0.0.255", "1.2.3.4.5",
                                 "256.1.1.1", " ", "-", "+", "7", "378282246310005", "é", "x@y", ".", "\n", "00300.1.2.3"]), max_size=9))
def test_base_spans_are_those_of_the_patterns(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == plain_spans(text)


def test_personal_data_of_documents(odd, none, docs):
    r = random.Random(5)
    rows = []
    for i in range(300):
        email = f"user{r.randrange(10**6)}@mail{r.randrange(9)}.example.com"
        phone = f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(10**4):04d}"
        rows.append((i, f"{prose(i, 20)} {email} {prose(i + 999, 9)} {phone} token 4.0. 77{r.randrange(10**7)} {i}.{i}"))
    rows += [(900, f"{prose(1, 9)} jane.doe77 (at) mail3.example.com {prose(2, 9)}"), (901, None), (902, "")]
    df = docs(*rows)
    found = {x.doc_id: x for x in pii.digests(df).collect()}
    for i, text in rows:
        base = plain_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert found[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (found[i].n_email, found[i].n_phone) == tuple(sum(s[0] == k for s in base) for k in ("email", "phone"))
        if i < 900:
            assert found[i].spans == joined
    assert "email" in found[900].spans and found[901].spans == "" == found[902].spans
    clean = {x.doc_id: x.text for x in pii.redact(df).collect()}
    assert "@" not in clean[5] and "<email>" in clean[5] and "<phone>" in clean[5] and clean[901] is None
    assert pii.redact(odd).columns == odd.columns and pii.redact(odd).count() == odd.count()
    assert pii.digests(none).count() == 0


def plain_boosting(x, y, rounds=6, depth=2, rate=0.3, bins=4, ridge=1.0):
    """Logistic boosting one split at a time, without bins' sums."""
    cuts = [sorted(set(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]))) for j in range(x.shape[1])]
    base = np.log(y.mean() / (1 - y.mean()))
    margin = np.full(len(y), base)

    def grow(rows, g, h, level):
        value = -g[rows].sum() / (h[rows].sum() + ridge)
        if level == depth or len(rows) < 8:
            return lambda i: value
        gain_of = lambda part: g[part].sum() ** 2 / (h[part].sum() + ridge)
        best = (1e-6, None, None)
        for j, own in enumerate(cuts):
            for cut in own:
                low, high = rows[x[rows, j] <= cut], rows[x[rows, j] > cut]
                if h[low].sum() < 1e-3 or h[high].sum() < 1e-3:
                    continue
                gain = gain_of(low) + gain_of(high) - gain_of(rows)
                if gain > best[0] + 1e-12:
                    best = (gain, j, cut)
        if best[1] is None:
            return lambda i: value
        _, j, cut = best
        left = grow(rows[x[rows, j] <= cut], g, h, level + 1)
        right = grow(rows[x[rows, j] > cut], g, h, level + 1)
        return lambda i: left(i) if x[i, j] <= cut else right(i)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(np.arange(len(y)), p - y, p * (1 - p), 0)
        margin = margin + rate * np.array([tree(i) for i in range(len(y))])
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("seed", range(4))
def test_trees_are_those_of_a_plain_version(seed):
    r = np.random.default_rng(seed)
    x = np.round(r.normal(size=(150, 4)), 2)
    y = ((x[:, 0] * x[:, 1] > 0) ^ (r.random(150) < 0.1)).astype(float)
    trees = boosting.Trees(x, y, rounds=6, depth=2, bins=4)
    assert trees.probability(x) == pytest.approx(plain_boosting(x, y), abs=1e-9)


@given(st.lists(st.tuples(st.integers(0, 10), st.booleans()), min_size=1, max_size=30))
def test_threshold_is_the_lowest_with_the_precision(pairs):
    p, y = np.array([a / 10 for a, _ in pairs]), np.array([float(b) for _, b in pairs])
    good = [c for c in sorted(set(p)) if c >= 0.5 and y[p >= c].mean() >= 0.9]
    got = pii._threshold(p, y, 0.9)
    if not good:
        assert got == 2.0
    else:
        assert set(np.flatnonzero(p >= got)) == set(np.flatnonzero(p >= good[0]))


def valid_card(r):
    body = "4" + "".join(r.choice("0123456789") for _ in range(14))
    return next(body + d for d in "0123456789" if pii.luhn(body + d))


def test_added_spans_of_held_out_texts_by_kind(docs):
    """Trees of one set of texts find other spellings in another one and leave what only looks alike."""
    r = random.Random(11)

    def filled(i, *things):
        return " ".join([prose(i, 12), *(f"{x} {prose(5000 * k + i, 6)}" for k, x in enumerate(things, 1))])

    def usual():
        return (
            f"user{r.randrange(10**6)}@mail{r.randrange(9)}.example.com", ".".join(str(r.randrange(1, 256)) for _ in range(4)),
            valid_card(r), f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(10**4):04d}", f'token = "{r.getrandbits(160):040x}"',
        )

    train = docs(*((i, filled(i, *usual(), "internationalization" + "s" * (i % 9))) for i in range(250)))
    model = pii.fit(train)
    assert all(model.thresholds[k] <= 1 for k in pii.ADDED)
    right, wrong, wanted = Counter(), Counter(), Counter()
    for i in range(300, 400):
        email, ip, card, phone, token = usual()
        secret = token.split('"')[1]
        bad = card[:-1] + str((int(card[-1]) + 3) % 10)
        true = {
            "email": email.replace("@", " (at) "), "ip": ip.replace(".", "[.]"),
            "card": ".".join(card[k : k + 4] for k in (0, 4, 8, 12)), "phone": phone[1:], "secret": secret,
        }
        false = ["see (at) noon", "version 3.4.1.2", f"{bad[:4]}.{bad[4:8]}.{bad[8:12]}.{bad[12:]}", "2021-05-17", "electroencephalography"]
        text = filled(i, *true.values(), *false)
        added = {(k, text[a:b]) for k, a, b in model.added(text, pii.base_spans(text))}
        for kind in pii.ADDED:
            mine = {s for k, s in added if k == kind}
            wanted[kind] += 1
            right[kind] += any(s in true[kind] and 2 * len(s) > len(true[kind]) for s in mine)
            wrong[kind] += sum(s not in true[kind] and true[kind] not in s for s in mine)
    for kind in pii.ADDED:
        assert right[kind] >= 0.9 * wanted[kind], (kind, right, wrong)
        assert wrong[kind] <= 0.05 * wanted[kind], (kind, right, wrong)


def slow_viterbi(scores, penalty):
    import itertools

    best = max(
        itertools.product(range(scores.shape[1]), repeat=len(scores)),
        key=lambda p: sum(scores[t, k] for t, k in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:])),
    )
    return sum(scores[t, k] for t, k in enumerate(best)) - penalty * sum(a != b for a, b in zip(best, best[1:]))


@pytest.mark.parametrize("seed", range(12))
def test_viterbi_is_the_best_of_all_sequences(seed):
    scores = np.random.default_rng(seed).normal(size=(7, 3)) * (1 + seed % 3)
    path = language.viterbi(scores, 1.5)
    own = sum(scores[t, k] for t, k in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))
    assert own == pytest.approx(slow_viterbi(scores, 1.5))


@pytest.mark.parametrize("seed", range(30))
def test_two_stretches_in_two_other_languages_cost_one_switch(seed):
    """A first half in one language and a second in another, with a third best over the whole text."""
    r = np.random.default_rng(seed)
    scores = 0.2 * r.normal(size=(40, 3))
    scores[:20, 0] += 0.4 + 0.4 * (seed % 4) / 3
    scores[20:, 0] -= 2
    scores[:20, 1] -= 2
    scores[20:, 1] += 0.4 + 0.4 * (seed % 4) / 3
    value = scores[0]
    for row in scores[1:]:
        value = np.maximum(value, value.max() - 12) + row
    path = language.viterbi(scores, 12)
    own = sum(scores[t, k] for t, k in enumerate(path)) - 12 * (path[1:] != path[:-1]).sum()
    assert own == pytest.approx(value.max())


def test_languages(docs, odd, none):
    letters = {"aa": "bcdfg", "bb": "klmnp", "ru": "бвгдж"}
    vowels = {"aa": "ae", "bb": "ou", "ru": "аио"}

    def text(lang, seed, n=40):
        r = random.Random(f"{lang}{seed}")
        return " ".join("".join(r.choice(letters[lang]) + r.choice(vowels[lang]) for _ in range(3)) for _ in range(n))

    rows = [(i, text(lang, i), lang) for i in range(120) for lang in [list(letters)[i % 3]]]
    rows += [(500, text("aa", 1, 30) + " " + text("ru", 2, 12) + " " + text("bb", 3, 20), None), (501, None, "aa"), (502, "12 !", "aa")]
    got = {r.doc_id: r for r in language.held_out_predictions(docs(*rows)).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:120])
    assert all(got[i].held_out == (crc32_of(i) % 4 == 2) for i, _, _ in rows)
    mixed = rows[120][1]
    assert [s.lang for s in got[500].spans] == ["aa", "ru", "bb"]
    assert [mixed[s.start : s.stop].split()[0] for s in got[500].spans] == [mixed.split()[k] for k in (0, 30, 42)]
    assert got[500].lang_pred == "aa" and 0 < got[500].score < 1
    assert got[501].lang_pred == got[502].lang_pred == "und"
    some = language.held_out_predictions(odd).collect()
    assert len(some) == odd.count() and {r.lang_pred for r in some if r.doc_id in (3, 4, 5, 9)} == {"und"}
    assert language.held_out_predictions(none).count() == 0


@pytest.mark.parametrize(("s", "t"), [("idiot", "idxiot"), ("worthless", "worth"), ("abcabc", "cab"), ("ab", "abc")])
def test_kernel_is_the_sum_over_common_subsequences(s, t):
    from itertools import combinations

    def spans(w):
        out = Counter()
        for at in combinations(range(len(w)), 3):
            out["".join(w[i] for i in at)] += 0.6 ** (at[-1] - at[0] + 1)
        return out

    a, b = spans(s), spans(t)
    own = toxicity.kernel(*(toxicity.codes([w])[0] for w in (s, t)))[0]
    assert own == pytest.approx(sum(v * b[k] for k, v in a.items()))


def test_longest_common_subsequence():
    from functools import cache

    @cache
    def slow(a, b):
        if not a or not b:
            return 0
        return slow(a[1:], b[1:]) + 1 if a[0] == b[0] else max(slow(a[1:], b), slow(a, b[1:]))

    words, marks = ["idxiot", "zzz", "scuxm", "élan"], ["idiot", "scum", "éan"]
    assert toxicity.common(words, marks).tolist() == [[slow(w, m) for m in marks] for w in words]


def test_toxic_texts_with_altered_insults(spark, docs, odd, none):
    insults = ["idiot", "worthless", "scum"]
    r = random.Random(2)
    rows, marks = [], []
    for i in range(400):
        text = prose(i, 60)
        toxic = i % 4 == 0
        if toxic:
            words = text.split(" ")
            for _ in range(2):
                words.insert(r.randrange(len(words)), r.choice(insults))
            text = " ".join(words)
        rows.append((i, text))
        marks.append((i, 1, int(toxic)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    changed = [(1000, prose(1, 30) + " idiiot, wor-th-less"), (1001, prose(2, 30) + " i d i o t scuum"), (1002, None), (1003, "")]
    got = {x.doc_id: x for x in toxicity.held_out_scores(docs(*rows, *changed), labels).collect()}
    held = [i for i in range(400) if crc32_of(i) % 5 == 0]
    assert all(got[i].held_out for i in held)
    assert np.mean([got[i].predicted == marks[i][2] for i in held]) >= 0.95
    assert got[1000].predicted == got[1001].predicted == 1 and got[1002].predicted == got[1003].predicted == 0
    assert len(toxicity.held_out_scores(odd, labels).collect()) == odd.count()
    assert toxicity.held_out_scores(none, labels).count() == 0
    assert {x.score for x in toxicity.held_out_scores(odd, labels.where("toxic = 0")).collect()} == {0.0}


def test_quality_keeps_good_and_rejects_junk(spark, docs, odd, none):
    rows, marks = [], []
    for i in range(300):
        text = prose(i, 80)
        if i % 5 == 0:
            text = " ".join(w + "***" for w in text.split())
        rows.append((i, text))
        if i % 3:
            marks.append((i, int(i % 5 != 0), 0))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {x.doc_id: x.selected for x in quality.resample(docs(*rows, (999, None)), labels).collect()}
    wrong = [i for i in range(300) if got[i] != (i % 5 != 0)]
    assert len(wrong) <= 3 and not got[999]
    assert sum(x.selected for x in quality.resample(docs(*rows), labels, k=17).collect()) == 17
    some = quality.resample(odd, labels).collect()
    assert len(some) == odd.count() and not any(x.selected for x in some if x.doc_id in (3, 4, 5))
    assert quality.resample(none, labels).count() == 0
    assert quality.resample(odd, labels.where("doc_id < 0")).count() == odd.count()


@pytest.mark.parametrize("k", [0, 1, 499, 5_000, 19_990, 30_000])
def test_top_k_is_that_of_a_sort(spark, k):
    df = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 100 > 0, F.floor(F.rand(3) * 400) / 7).alias("key")
    )
    df = packing.stage(df)
    got = {r.doc_id for r in quality.top_k(df, "key", k, ["doc_id"], 64).where("selected").collect()}
    rows = sorted((-r.key, r.doc_id) for r in df.collect() if r.key is not None)
    assert got == {d for _, d in rows[:k]}


def plain_losses(texts, targets, word_share, pair_share):
    """Bigram losses with dictionaries: what the vectorised models compute."""
    words = [(t or "").lower().split() for t in texts]
    count = Counter(w for ws in words for w in ws)
    total = sum(count.values())
    vocab = {w for w, n in count.items() if n >= max(2, word_share * total)}
    seqs = [["<s>", *(w if w in vocab else "<unk>" for w in ws)] for ws in words]
    pairs = Counter(p for s in seqs for p in zip(s, s[1:]))
    listed = {p for p, n in pairs.items() if n >= max(2, pair_share * total)}
    out = []
    for chosen in (targets, [True] * len(texts)):
        own = [s for s, c in zip(seqs, chosen) if c]
        two = Counter(p for s in own for p in zip(s, s[1:]))
        first = Counter(w for s in own for w in s[:-1])
        one = Counter(w for s in own for w in s[1:])
        size = len(vocab) + 1
        p1 = {w: (one[w] + 0.5) / (sum(one.values()) + 0.5 * size) for w in [*vocab, "<unk>"]}
        rest = {w: 1.0 for w in [*vocab, "<unk>", "<s>"]}
        for a, b in listed:
            if first[a]:
                rest[a] -= max(two[a, b] - 0.5, 0) / first[a]

        def loss(a, b, two=two, first=first, rest=rest, p1=p1):
            direct = max(two[a, b] - 0.5, 0) / first[a] if (a, b) in listed and first[a] else 0
            return -np.log(direct + max(rest[a], 1e-9) * p1[b])

        out.append([np.mean([loss(a, b) for a, b in zip(s, s[1:])]) if len(s) > 1 else None for s in seqs])
    return out


def test_cross_entropies_are_those_of_dictionaries(docs, odd, none):
    texts = [" ".join(random.Random(i).choices("a b c d e f g hh ii jj kk".split(), k=30)) for i in range(40)] + [None, "", "a"]
    df = docs(*enumerate(texts))
    model = lm.fit(df, df.where("doc_id % 3 = 0").select("doc_id"), 0.06, 0.004)
    got = {r.doc_id: r for r in lm.score(df, model).collect()}
    target, background = plain_losses(texts, [i % 3 == 0 for i in range(len(texts))], 0.06, 0.004)
    for i in range(len(texts)):
        if target[i] is None:
            assert got[i].ce_difference is None and got[i].n_words == 0
        else:
            assert got[i].ce_target == pytest.approx(target[i], rel=1e-4)
            assert got[i].ce_background == pytest.approx(background[i], rel=1e-4)
            assert got[i].ce_difference == pytest.approx(target[i] - background[i], abs=1e-4)
    some = lm.score(odd, lm.fit(odd, odd.select("doc_id"))).collect()
    assert len(some) == odd.count()
    assert lm.score(none, lm.fit(none, none)).count() == 0


def whole_losses(texts, wanted):
    """Losses a word under the models of all words and bigrams, from dictionaries."""
    lists = [[f"{w}" for w in (text or "").split()] for text in texts]
    out = []
    for k in (0, 1):
        n, pairs, starts = Counter(), Counter(), 0
        for own, t in zip(lists, wanted):
            if t or k:
                n.update(own)
                pairs.update(zip([None, *own], own))
                starts += bool(own)
        distinct, total = len({w for own in lists for w in own}), sum(n.values())

        def loss(a, b):
            base = lm.PRIOR * (n[b] + 0.5) / (total + 0.5 * distinct)
            return np.log((n[a] if a else starts) + lm.PRIOR) - np.log(pairs[a, b] + base)

        out.append([np.mean([loss(*ab) for ab in zip([None, *own], own)]) if own else None for own in lists])
    return out


@pytest.mark.parametrize("sent", [lm.SENT, 0.02, 1.0])
def test_every_word_and_bigram_counts_listed_or_not(docs, odd, none, sent):
    r = random.Random(5)
    words = ["a", "b", "c", *(f"w{i}" for i in range(300))]
    texts = [" ".join(r.choices(words, [60, 40, 30] + [1] * 300, k=r.randrange(1, 60))) for _ in range(80)]
    texts += [None, "", "once", "once", "a b a b w1 w1 w1", *["same words again and again"] * 5]
    ids = [*range(80), 80, 81, 82, 82, 83, None, None, 84, 84, 84]  # repeated rows, and rows without an id
    wanted = [i is not None and i % 3 == 0 for i in ids]
    df = docs(*zip(ids, texts))
    got = lm.whole_scores(df, df.where("doc_id % 3 = 0").select("doc_id"), sent).collect()
    target, background = whole_losses(texts, wanted)
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or 0)
    want = sorted(((i, t, b) for i, t, b in zip(ids, target, background)), key=key)
    have = sorted(((x.doc_id, x.ce_target, x.ce_background) for x in got), key=key)
    assert [x[0] for x in have] == [x[0] for x in want]
    for x, y in zip(have, want):
        assert x[1:] == (None, None) if y[1] is None else x[1:] == pytest.approx(y[1:], rel=1e-9)
    assert lm.whole_scores(odd, odd.select("doc_id"), sent).count() == odd.count()
    assert lm.whole_scores(none, none, sent).count() == 0
