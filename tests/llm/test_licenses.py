"""Licence scan against all blocks and templates."""

from __future__ import annotations

import random
import re

from pensio.llm import licenses
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def pairs(w):
    return set(zip(w, w[1:]))


def plain_scan(text, templates, percent):
    w, step = words(text), max(len(words(t)) for _, t in templates)
    out = set()
    for start in range(0, len(w), step):
        block = pairs(w[start : start + 2 * step])
        for k, (label, t) in enumerate(templates):
            own = pairs(words(t))
            if 100 * len(own & block) >= percent * len(own):
                out.add((start, min(start + 2 * step, len(w)), k, label, len(own & block), len(own & block) / len(own)))
    return out


def texts():
    r = random.Random(2)
    for i in range(120):
        out = prose(i, r.randint(0, 150)).split()
        for _ in range(r.randint(0, 3)):
            t = r.choice(licenses.TEMPLATES)[1].split()
            for _ in range(r.randint(0, 4)):  # words changed, dropped or added
                at = r.randrange(len(t))
                t[at : at + 1] = r.choice([["other"], [], [t[at], "more"]])
            at = r.randint(0, len(out))
            out[at:at] = t
        yield i, r.choice([" ", "\n", " // "]).join(out)


def test_found_blocks_are_all_that_reach_the_threshold(docs):
    rows = list(texts())
    for percent in (60, 80, 100):
        wanted = {(i, *b) for i, t in rows for b in plain_scan(t, licenses.TEMPLATES, percent)}
        got = {tuple(r) for r in licenses.scan(docs(*rows), percent=percent).collect()}
        assert got == wanted and len(wanted) > 20


def test_rare_tokens_come_first(docs):
    index = licenses.Index.build(licenses.TEMPLATES, licenses.frequencies(docs(*texts())), 80)
    counts = licenses.frequencies(docs(*texts()))
    by_rank = [counts.get(int(index.known[i]), 0) for i in index.rank.argsort()]
    assert by_rank == sorted(by_rank)


def test_digests(docs):
    rows = [*texts(), (900, "The GENERAL public\tLicense. general (public) license"), (901, "mité license mit"), (902, "MIT-License")]
    got = {r.doc_id: r for r in licenses.digests(docs(*rows)).collect()}
    for i, text in rows:
        w = words(text)
        base = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        found = plain_scan(text, licenses.TEMPLATES, licenses.PERCENT)
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(base))
        assert (r.first_word, r.last_word) == ((min(base)[0], max(base)[0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({b for _, b in base}))
        assert r.labels == ",".join(sorted({b for _, b in base} | {b[3] for b in found}))
        assert r.score == (1.0 if base else max((b[5] for b in found), default=0.0))
    assert (got[900].n_base, got[900].first_word, got[900].last_word) == (2, 1, 4)
    assert got[901].n_base == 0 and got[902].n_base == 1


def test_odd_rows_and_empty_tables(odd, none, docs):
    got = licenses.digests(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        if r.doc_id in (3, 4, 5):
            assert (r.n_words, r.n_base, r.first_word, r.labels, r.score) == (0, 0, None, "", 0.0)
    assert licenses.digests(none).count() == licenses.scan(none).count() == 0
    twice = licenses.scan(docs((1, "all rights reserved"), (1, "all rights reserved"), (None, "All rights reserved."))).collect()
    assert sorted(str(r.doc_id) for r in twice) == ["1", "1", "None"]
