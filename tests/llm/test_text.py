"""Words, shingles and components against plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from pensio.llm.common import Words, components, union_find

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(text, size):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aAbÉß\n\t 日\x1c\xa0.", max_size=30)), min_size=1, max_size=8), st.integers(1, 5))
def test_shingle_sets_are_those_of_plain_words(texts, size):
    rows, h = Words(pa.array(texts, pa.string())).sets(size)
    wanted = [plain(t, size) for t in texts]
    assert [int((rows == i).sum()) for i in range(len(texts))] == [len(w) for w in wanted]
    for i in range(len(texts)):
        for j in range(len(texts)):
            both = len(np.intersect1d(h[rows == i], h[rows == j]))
            assert both == len(wanted[i] & wanted[j])


def test_slices_of_an_array_are_read_from_their_offset():
    whole = pa.array(["a b", "c d e", None, "f"])
    assert len(Words(whole.slice(1, 2)).hash) == 3


def reach(links):
    low = {}

    def root(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        low[y] = x
    return {x: root(x) for x in list(low)}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    r = random.Random(3)
    links = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(0, i) for i in range(1, 200)] + [(5, 900)],
        "random": [(r.randrange(150), r.randrange(150)) for _ in range(110)],
        "none": [],
    }[kind]
    df = spark.createDataFrame(links, "src long, dst long").repartition(7)
    got = {x.node: x.component_id for x in components(df).collect()}
    assert got == {k: v for k, v in reach(links).items() if any(k in x and x[0] != x[1] for x in links)}
    a, b = (np.array([x[i] for x in links], np.int64) for i in (0, 1))
    if links:
        assert dict(zip(*(x.tolist() for x in union_find(a, b)))) == reach(links)
