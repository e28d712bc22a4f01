"""Jaccard join, passages, vectors and test items against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pensio.llm import decontaminate, jaccard, neighbours, substring
from tests.llm.conftest import prose
from tests.llm.test_text import plain, reach


def altered(text, changes, seed):
    r, words = random.Random(seed), text.split(" ")
    for _ in range(changes):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_links_and_components_are_those_of_all_pairs(docs, size, percent):
    base = [prose(s, 150) for s in range(6)]
    rows = [(i, base[i]) for i in range(6)]
    for i in range(140):  # a cloud of near copies around each base, most of them near the threshold
        rows.append((10 + i, altered(base[i % 6 if i % 2 else 0], i % 9, i)))
    rows += [(200, base[0].upper()), (201, "two words"), (202, "Two  words"), (203, None), (204, " ")]
    sets = {i: plain(t, size) for i, t in rows}
    links = []
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    wanted = {i: reach(links).get(i, i) for i in sets}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar(docs(*rows), size, percent).collect()}
    assert got == {i: (len(sets[i]), wanted[i]) for i in sets}
    left = {r.doc_id for r in jaccard.deduplicate(docs(*rows), size, percent).collect()}
    assert left == set(wanted.values())


def test_links_within_a_prefix_group_need_not_pass_its_first_member(docs):
    """Texts of one prefix and size: the first links with none, the other two with each other."""

    def look(text):
        h = np.sort(jaccard.Words(pa.array([text])).sets(3)[1])
        return len(h), h[: jaccard.prefix_size(len(h), 90)].tolist(), set(h.tolist())

    def linked(x, y):
        return 100 * len(x[2] & y[2]) >= 90 * len(x[2] | y[2])

    rows, wanted = [], {}
    for seed in range(60):
        words, r = prose(5000 + seed, 100).split(" "), random.Random(seed)
        b, c = " ".join(words), " ".join([*words[:-1], "near"])
        for _ in range(20):
            cut = r.sample(range(1, 99), 2)
            a = " ".join("far" if i in cut else w for i, w in enumerate(words))
            x, y, z = map(look, (a, b, c))
            if x[:2] == y[:2] == z[:2] and linked(y, z) and not linked(x, y) and not linked(x, z):
                i = 3 * len(rows)
                rows += [(i, a), (i + 1, b), (i + 2, c)]
                wanted |= {i: i, i + 1: i + 1, i + 2: i + 1}
                break
    assert len(rows) > 30
    got = {r.doc_id: r.component_id for r in jaccard.similar(docs(*rows)).collect()}
    assert got == wanted


def test_odd_rows_of_the_join(odd, none):
    got = Counter((r.doc_id, r.component_id) for r in jaccard.similar(odd).collect())
    assert got[1, 1] == 2 and got[2, 1] == 1 and got[3, 3] == 1 and got[None, None] == 1
    assert sum(got.values()) == odd.count()
    assert jaccard.similar(none).count() == 0
    assert set(jaccard.deduplicate(odd).columns) == set(odd.columns)


def test_passages_inside_other_texts_are_found(docs):
    passage = prose(99, 60)
    rows = [(i, prose(i, 300)) for i in range(20)]
    for i in range(20, 26):
        words = prose(i, 300).split(" ")
        cut = 20 + 31 * (i - 19)
        rows.append((i, " ".join([*words[:cut], passage, *words[cut:]])))
    rows.append((26, prose(26, 300) + "\n" + altered(passage, 1, 5)))
    found = substring.repeated(docs(*rows)).collect()
    assert {r.doc_id for r in found} >= set(range(20, 26))
    assert not {r.doc_id for r in found} & set(range(20))
    texts = dict(rows)
    for r in found:
        assert r.kept == ((r.doc_id, r.paragraph) == (r.first_doc_id, r.first_paragraph))
        if r.doc_id < 26:
            assert texts[r.doc_id][r.start : r.stop] in passage or r.run_words > 60
    assert any(r.kept for r in found)


def test_paragraphs_that_share_a_band_meet_whatever_comes_first(docs):
    """Clusters are those of all pairs with a band in common, where most paragraphs of a band are too far apart."""
    r, rows = random.Random(3), []
    for k in range(12):
        base = prose(900 + k, 45)
        rows += [altered(base, 3, 100 * k + i) for i in range(12)]
        near = altered(base, 3, 100 * k + 50)
        rows += [near, near, near + " x", altered(near, 1, 100 * k + 51)]
    r.shuffle(rows)
    own = substring.Paragraphs(pa.array(rows))
    row, h = own.sets()
    keys = substring.band_keys(row, h, len(own.row), substring.bands())
    sets = [set(h[row == i].tolist()) for i in range(len(own.row))]
    names = [(int(own.row[i]), int(own.number[i])) for i in range(len(sets))]
    links = []
    for i in range(len(sets)):
        for j in range(i):
            if (keys[i] == keys[j]).any() and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links.append((names[j], names[i]))
    wanted = reach(links)
    # In one batch and in many.
    for pieces in (1, 7):
        found = substring.repeated(docs(*enumerate(rows)).repartition(pieces), min_run=0).collect()
        assert {(x.doc_id, x.paragraph): (x.first_doc_id, x.first_paragraph) for x in found} == wanted


def test_passages_of_lower_case_words_without_stops_are_found(docs):
    def plain_words(seed, count):
        return prose(seed, count).lower().replace(".", "")

    rows = []
    for k in range(40):
        passage = plain_words(7000 + k, 80)
        for i in (0, 1):
            before, after = (plain_words(8000 + 4 * k + 2 * i + j, 100 + 7 * k) for j in (0, 1))
            rows.append((2 * k + i, f"{before} {passage} {after}"))
    found = substring.repeated(docs(*rows)).collect()
    texts = dict(rows)
    assert len({r.doc_id for r in found}) >= 74
    assert all(r.n_words < substring.LONG for r in found)
    for r in found:
        # A paragraph may differ by a word at its end.
        assert " ".join(texts[r.doc_id][r.start : r.stop].split(" ")[2:-2]) in texts[r.doc_id ^ 1]


def test_documents_of_any_id_and_repeated_rows(docs):
    passage, high = prose(99, 60), 1 << 62
    mine = prose(31, 100)
    rows = [(high + i, f"{prose(40 + i, 100)} {passage}") for i in range(3)] + [(5, mine), (5, mine), (6, mine), (7, prose(8, 90))]
    for pieces in (1, 4):
        found = substring.repeated(docs(*rows).repartition(pieces)).collect()
        assert {r.doc_id for r in found} == {high, high + 1, high + 2, 5, 6}
        assert len({(r.doc_id, r.paragraph) for r in found}) == len(found)
        assert {r.first_doc_id for r in found} == {high, 5}
        assert all(r.kept == (r.doc_id == r.first_doc_id) for r in found)


def test_odd_rows_of_passages(odd, none):
    found = substring.repeated(odd).collect()
    assert {r.doc_id for r in found} == {1, 2}
    assert substring.repeated(none).count() == 0


def test_bands_reach_the_recall():
    b, r = substring.bands(0.8, 0.99)
    assert 1 - (1 - 0.8**r) ** b >= 0.99


def test_vectors_against_all_pairs(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(900, 24)).astype(np.float32)
    x[300:420] = x[0] + 0.15 * r.normal(size=(120, 24))  # a dense group
    x[500:520] = x[1]  # exact copies
    x[600:660] = x[540:600] * 3 + 0.1 * r.normal(size=(60, 24))
    labels = [None if i == 7 else int(i % 3 != 0) for i in range(900)]
    rows = [(i, [float(v) for v in x[i]], labels[i]) for i in range(900)]
    rows[20] = (20, None, 1)
    rows[21] = (21, [0.0] * 24, 1)
    rows[22] = (22, [float("nan")] * 24, 1)
    rows[23] = (23, [1.0, None] * 12, 1)
    rows[24] = (24, [], 1)
    rows[25] = (25, [1.0, 2.0], 1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    bad = {7, 20, 21, 22, 23, 24, 25}
    unit = neighbours.normalised(x)
    cos = unit @ unit.T
    links = [
        (i, j) for i in range(900) for j in range(i) if cos[i, j] >= 0.93 and labels[i] == labels[j] and not {i, j} & bad
    ]
    degree = Counter(v for p in links for v in p)
    got = {r.vec_id: r for r in neighbours.near_duplicates(df).collect()}
    assert len(got) == 900
    assert all(got[i].n_links <= degree[i] for i in range(900))
    assert sum(got[i].n_links for i in range(900)) >= 0.98 * sum(degree.values())
    low = reach(links)
    same = sum(got[i].component_id == low.get(i, i) for i in range(900))
    assert same >= 0.98 * 900
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert neighbours.audit(df, neighbours.near_duplicates(df), 200) >= 0.9


def test_large_cells_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    r = np.random.default_rng(1)
    x = r.normal(size=16) + 0.12 * r.normal(size=(200, 16))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], 1) for i in range(200)], "vec_id long, embedding array<float>, label int")
    x = neighbours.normalised(x.astype(np.float32))
    wanted = ((x @ x.T) >= 0.93).sum(1) - 1
    got = np.array([r.n_links for r in sorted(neighbours.near_duplicates(df).collect())])
    assert got.sum() >= 0.97 * wanted.sum() and (got <= wanted).all()
    none = neighbours.near_duplicates(df.where("vec_id < 0"))
    assert none.count() == 0


def test_items_are_found_with_few_changes_and_nothing_else(spark, docs):
    items = [(i, prose(1000 + i, 30) + " " + prose(2000 + i, 12)) for i in range(40)]
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (3, items[3][1])], "item_id long, text string")
    rows = [(i, prose(i, 200)) for i in range(40)]
    for i in range(40, 60):
        words = prose(i, 400).split(" ")
        cut = 17 * (i - 39)
        rows.append((i, " ".join([*words[:cut], items[i - 40][1], *words[cut:]])))
    rows.append((60, prose(60, 100) + " " + altered(items[20][1], 1, 2) + " " + prose(61, 100)))
    rows.append((62, " ".join(items[21][1].split(" ")[:12])))
    wanted = {(i, i - 40) for i in range(40, 60)}
    for i, t in rows:
        for k, item in items:
            share = plain(item, 5)
            if len(share & plain(t, 5)) >= 0.8 * len(share):
                wanted.add((i, k))
    df = docs(*rows)
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    assert got == wanted
    left = {r.doc_id for r in decontaminate.decontaminate(df, bench).collect()}
    assert left == {i for i, _ in rows} - {i for i, _ in wanted}


def test_items_that_lack_just_a_fifth_of_their_shingles_are_found(spark, docs):
    """5, 10 and 25 shingles, cut at the end by a fifth of them."""
    items, rows = [], []
    for i, (count, less) in enumerate([(9, 1), (14, 2), (29, 5)] * 6):
        words = prose(400 + i, count).lower().replace(".", "").split(" ")
        items.append((i, " ".join(words)))
        rows.append((i, " ".join([prose(500 + i, 60), *words[: count - less], prose(600 + i, 60)])))
        rows.append((100 + i, " ".join([prose(500 + i, 60), *words[: count - less - 1], prose(600 + i, 60)])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.overlap for r in decontaminate.contaminated(docs(*rows), bench).collect()}
    assert got == {(i, i): 0.8 for i in range(len(items))}


def test_items_of_few_words_match_whole_texts_only(spark, docs):
    bench = spark.createDataFrame([(1, "who wrote faust")], "item_id long, text string")
    found = decontaminate.contaminated(docs((1, "Who wrote Faust"), (2, "They asked who wrote faust and left")), bench)
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 1)]


def test_odd_rows_of_decontamination(spark, odd, none):
    bench = spark.createDataFrame([(1, prose(1, 120)), (2, "word")], "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, bench).collect())
    assert got == {(1, 1): 2, (2, 1): 1, (10, 2): 1}
    assert decontaminate.decontaminate(odd, bench).columns == odd.columns
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.decontaminate(odd, bench.where("item_id < 0")).count() == odd.count()


def test_pairs_at_the_threshold_meet_among_many_cells(spark, monkeypatch):
    """Random vectors and partners at just above the threshold, with more than a hundred cells for one label."""
    monkeypatch.setattr(neighbours, "CELL", 20)
    r = np.random.default_rng(8)
    x = neighbours.normalised(r.normal(size=(1300, 64)))
    w = r.normal(size=x.shape)
    w = neighbours.normalised(w - x * (x * w).sum(1, keepdims=True))
    y = 0.932 * x + np.sqrt(1 - 0.932**2) * w
    rows = [(i, v.tolist(), "one label") for i, v in enumerate(np.concatenate([x, y]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    nodes = df.selectExpr("vec_id as node", "label", "size(embedding) as dim", "1L as copies", "embedding")
    assert len(neighbours.fit_centres(nodes)[("one label", 64)][0]) > 100
    result = neighbours.near_duplicates(df)
    assert neighbours.audit(df, result, 2600) >= 0.98
    found = {v.vec_id: v.component_id for v in result.collect()}
    assert np.mean([found[i] == found[i + 1300] for i in range(1300)]) >= 0.98


def test_vectors_of_any_label_type_size_and_repetition(spark):
    big = [1e300, 2e300, 0.0]
    rows = [(1, big, 5_000_000_000), (2, big, 5_000_000_000), (2, big, 5_000_000_000), (3, [1.0, 2.0, 0.0], 5_000_000_000),
            (4, big, 7), (5, None, 7), (6, big, None), (7, [0.93, (1 - 0.93**2) ** 0.5, 0.0], 8), (8, [1.0, 0.0, 0.0], 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").selectExpr("*", "1 as node", "2 as cell", "'h' as h")
    got = sorted((v.vec_id, v.n_links, v.component_id, v.kept) for v in neighbours.near_duplicates(df).collect())
    linked = float(np.dot(*neighbours.normalised([rows[7][1], rows[8][1]]))) >= 0.93
    assert got == [
        (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (3, 3, 1, False), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
        (7, int(linked), 7, True), (8, int(linked), 7 if linked else 8, not linked),
    ]
    assert neighbours.near_duplicates(df.where("vec_id > 99")).count() == 0
