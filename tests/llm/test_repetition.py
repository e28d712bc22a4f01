"""Periodic runs against the definition, word by word."""

from __future__ import annotations

import hashlib
import random

from pensio.llm import repetition
from pensio.llm.common import crc32_of

EMPTY = hashlib.sha256(b"").hexdigest()


def plain_runs(w):
    """Every lag, every maximal stretch that keeps it, without those that keep a smaller one throughout."""
    out = []
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            e = i + q
            if i > s and e - s >= max(6, 4 * q):
                if not any(all(w[x] == w[x + p] for x in range(s, e - p)) for p in range(1, q)):
                    out.append((s, e - s, q))
            i = max(i, s + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def stuttering(r):
    """Words of few kinds with repeated stretches of all periods."""
    w = []
    while len(w) < r.randint(0, 120):
        if r.random() < 0.5:
            w += [r.choice("abc") for _ in range(r.randint(1, 6))]
        else:
            unit = [r.choice("ab" + ("cdefgh" if r.random() < 0.5 else "")) for _ in range(r.randint(1, 14))]
            w += (unit * 9)[: r.randint(1, len(unit) * 8)]
    return w


def test_runs_are_those_of_the_definition():
    r = random.Random(5)
    for _ in range(500):
        texts = [" ".join(stuttering(r)) for _ in range(r.randint(0, 4))]
        found = repetition.Batch(texts)
        for k, text in enumerate(texts):
            mine = slice(found.of[k], found.of[k + 1])
            got = list(zip(*(x[mine].tolist() for x in (found.place, found.length, found.period))))
            assert got == plain_runs(text.split())


def test_long_runs_and_long_texts(monkeypatch):
    """A word repeated very often gives as many seeds as words, not their square; stretches do not change words."""
    words = [f"w{i % 3001}" for i in range(40_000)] + ["x"] * 60_000
    place = repetition.Batch([" ".join(words)])
    assert list(zip(place.place, place.length, place.period)) == [(0, 40_000, 3001), (40_000, 60_000, 1)]
    whole = place.words
    monkeypatch.setattr(repetition, "STRETCH", 100)
    assert (repetition.Batch([" ".join(words)]).words == whole).all()


def plain_digest(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None and n and crc32_of(doc_id) % 10 == 0:
        g = crc32_of(doc_id) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in drop)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def test_digests_of_rewritten_documents(docs):
    r = random.Random(9)
    rows = [(i, " ".join(stuttering(r))) for i in range(150)] + [(150, "Élan élan Élan x " * 9)]
    got = repetition.digests(docs(*rows), repetition.planted).collect()
    assert sorted(tuple(x) for x in got) == sorted(plain_digest(*x) for x in rows)


def test_odd_rows_and_empty_tables(odd, none):
    short = odd.where("length(text) < 2000 or text is null")
    got = repetition.digests(odd, repetition.planted).collect()
    assert len(got) == odd.count()
    wanted = sorted(map(str, (plain_digest(r.doc_id, r.text) for r in short.collect())))
    ids = {r.doc_id for r in short.collect()}
    assert sorted(str(tuple(x)) for x in got if x.doc_id in ids) == wanted
    blank = [x for x in got if x.doc_id in (3, 4, 5)]
    assert all((x.n_runs, x.start, x.runs_sha256, x.collapsed_sha256) == (0, None, EMPTY, EMPTY) for x in blank)
    assert repetition.digests(none).count() == repetition.periodic_runs(none).count() == repetition.collapse(none).count() == 0
    same = repetition.collapse(odd)
    assert same.dtypes == odd.dtypes
    assert sorted(map(str, same.collect())) == sorted(map(str, odd.collect()))


def test_runs_and_collapsed_texts(docs):
    frame = docs((1, "so  " + "on and " * 5 + "off"), (2, "a\n\nb"), (3, "no " * 6), (3, "no " * 6))
    assert sorted(tuple(r) for r in repetition.periodic_runs(frame).collect()) == [(1, 1, 10, 2), (3, 0, 6, 1), (3, 0, 6, 1)]
    assert sorted((r.doc_id, r.text) for r in repetition.collapse(frame).collect()) == [
        (1, "so on and off"), (2, "a\n\nb"), (3, "no"), (3, "no"),
    ]
