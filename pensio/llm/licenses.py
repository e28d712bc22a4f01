"""Licence scan: an exact set-similarity join of text blocks with licence templates.

Words are runs of ASCII letters (lower-cased) and digits and of anything beyond ASCII. A token is a pair of neighbouring
words; a template is the set of its tokens. A text is cut into overlapping blocks of twice the longest template's words,
one starting every that many words, so a stretch of a template's length lies whole in one of them. A block is found for
a template if it holds at least ``PERCENT`` percent of the template's tokens. No such block is lost:

1. Order. The tokens of all templates are counted in all documents (one row a token and batch leaves a task; the result
   is as long as the template list) and ordered from rare to frequent. Other tokens of a text meet no template and are
   left out at once.
2. Prefix. A template of m tokens that needs p of them shares one of its m - p + 1 first tokens with every block that
   reaches p, and so does the block within its own first n - p + 1. Only these prefixes meet, in an inverted index.
3. Length and position. A block with fewer than p tokens is passed over, and so is a pair whose first common token
   leaves fewer than p on either side.
4. What is left is counted exactly.

Templates are an argument and their index travels with the tasks, so its size is that of the list given, whatever the
corpus. A document is one row, nothing is shuffled but the token counts. Base places are phrases whose words stand
consecutively, see ``PHRASES``.

A null, empty or wordless text has no places, no blocks, empty labels and score 0. Repeated rows give repeated results,
other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pensio.llm.common import Words, map_batches, mix

PERCENT = 80
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

# Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Sentences and notices of public licences, with their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
            "Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("proprietary", "All rights reserved."),
)

# Bytes that are no part of a word: all of ASCII but letters and digits.
SPACE = np.zeros(256, bool)
SPACE[:128] = [not chr(b).isalnum() for b in range(128)]


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of each word that has another one after it in its text, with that one."""
    at = np.flatnonzero(words.row[:-1] == words.row[1:])
    return at, mix(words.hash[at] * _FACTOR + words.hash[at + 1])


def _token_sets(templates) -> list[np.ndarray]:
    texts = Words(pa.array([t for _, t in templates], pa.string()), SPACE)
    at, h = tokens(texts)
    sets = [np.unique(h[texts.row[at] == i]) for i in range(len(templates))]
    if not all(len(s) for s in sets):
        raise ValueError("a template needs two words at least")
    return sets


def step_of(templates) -> int:
    """Words from the start of one block to that of the next: those of the longest template."""
    return int(np.diff(Words(pa.array([t for _, t in templates], pa.string()), SPACE).first).max())


def needed(size, percent: int):
    return -(-size * percent // 100)


def frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[int, int]:
    """How often each token of the templates occurs in all texts of ``docs``; as long as the template list."""
    known = np.unique(np.concatenate(_token_sets(templates)))

    def make():
        def step(batch):
            _, h = tokens(Words(batch.column("text"), SPACE))
            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
            n = np.bincount(place[known[place] == h], minlength=len(known))
            return {"token": known[n > 0], "n": n[n > 0]}

        return step

    counted = map_batches(docs.select("text"), "token long, n long", make).groupBy("token").agg(F.sum("n").alias("n"))
    return {r.token & (1 << 64) - 1: r.n for r in counted.collect()}


@dataclass
class Index:
    """Templates by their tokens' ranks, rare tokens first; ``entry`` lists the prefixes by token."""

    labels: list[str]
    known: np.ndarray  # token hashes, ascending
    rank: np.ndarray  # and their ranks
    sizes: np.ndarray
    need: np.ndarray
    members: np.ndarray  # template * number of tokens + rank, ascending
    entry: np.ndarray  # where a rank's prefix entries start
    entry_template: np.ndarray
    entry_place: np.ndarray
    step: int

    @classmethod
    def build(cls, templates, counts: dict[int, int], percent: int) -> Index:
        sets = _token_sets(templates)
        known = np.unique(np.concatenate(sets))
        order = sorted(range(len(known)), key=lambda i: (counts.get(int(known[i]), 0), int(known[i])))
        rank = np.empty(len(known), np.int64)
        rank[order] = np.arange(len(known))
        ranked = [np.sort(rank[np.searchsorted(known, s)]) for s in sets]
        sizes = np.array([len(s) for s in sets])
        need = needed(sizes, percent)
        rows = sorted((int(r), t, i) for t, s in enumerate(ranked) for i, r in enumerate(s[: sizes[t] - need[t] + 1]))
        entries = np.array(rows, np.int64)
        return cls(
            [label for label, _ in templates], known, rank, sizes, need,
            np.concatenate([t * len(known) + s for t, s in enumerate(ranked)]),
            np.searchsorted(entries[:, 0], np.arange(len(known) + 1)), entries[:, 1], entries[:, 2], step_of(templates),
        )

    def search(self, words: Words) -> dict[str, np.ndarray]:
        """Found blocks: row, block (its number in the row), template and tokens in common."""
        at, h = tokens(words)
        place = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        hit = self.known[place] == h
        at, rank = at[hit], self.rank[place[hit]]
        row = words.row[at]
        local = at - words.first[row]
        own = local // self.step  # the block that starts last before it, and the one before unless the pair leaves it
        earlier = (own > 0) & (local % self.step < self.step - 1)
        key = (np.concatenate([row, row[earlier]]) << 32) + np.concatenate([own, own[earlier] - 1])
        rank = np.concatenate([rank, rank[earlier]])
        order = np.lexsort((rank, key))
        key, rank = key[order], rank[order]
        keep = np.ones(len(key), bool)
        keep[1:] = (key[1:] != key[:-1]) | (rank[1:] != rank[:-1])
        key, rank = key[keep], rank[keep]
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(head, len(key)))
        of = np.repeat(np.arange(len(head)), size)
        spot = np.arange(len(key)) - head[of]

        # Prefixes of blocks meet prefixes of templates.
        short = spot <= size[of] - self.need.min()
        block, spot, r = of[short], spot[short], rank[short]
        many = self.entry[r + 1] - self.entry[r]
        source = np.repeat(np.arange(len(r)), many)
        entry = np.arange(len(source)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.entry[r], many)
        block, spot, template, where = block[source], spot[source], self.entry_template[entry], self.entry_place[entry]
        # The first common token of a pair comes first: tokens of a block are in rank order.
        pair = block * len(self.labels) + template
        _, one = np.unique(pair, return_index=True)
        block, spot, template, where = block[one], spot[one], template[one], where[one]
        n, m, p = size[block], self.sizes[template], self.need[template]
        fits = (n >= p) & (np.minimum(m - where, n - spot) >= p)
        block, template = block[fits], template[fits]

        # Exact count.
        many = size[block]
        source = np.repeat(np.arange(len(block)), many)
        token = np.arange(len(source)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(head[block], many)
        asked = template[source] * len(self.known) + rank[token]
        member = np.minimum(np.searchsorted(self.members, asked), len(self.members) - 1)
        both = np.bincount(source[self.members[member] == asked], minlength=len(block))
        good = both >= self.need[template]
        key = key[head[block[good]]]
        return {"row": key >> 32, "block": key & 0xFFFFFFFF, "template": template[good], "both": both[good]}


def scan(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """(doc_id, start, stop, template, label, shared, containment) of every found block of ``docs`` (doc_id, text).

    ``start`` and ``stop`` are word places, ``template`` a place in ``templates``.
    """
    index = Index.build(templates, frequencies(docs, templates), percent)
    schema = "doc_id long, start long, stop long, template int, label string, shared long, containment double"

    def make():
        def step(batch):
            words = Words(batch.column("text"), SPACE)
            found = index.search(words)
            row, template = found["row"], found["template"]
            start = found["block"] * index.step
            return {
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "start": start,
                "stop": np.minimum(start + 2 * index.step, np.diff(words.first)[row]),
                "template": template,
                "label": [index.labels[t] for t in template],
                "shared": found["both"],
                "containment": found["both"] / index.sizes[template],
            }

        return step

    return map_batches(docs.select("doc_id", "text"), schema, make)


def places(words: Words, phrases=PHRASES) -> tuple[np.ndarray, np.ndarray]:
    """Place and number of every phrase whose words stand consecutively in one text."""
    own = Words(pa.array([p for p, _ in phrases], pa.string()), SPACE)
    at, which = [], []
    for k in range(len(phrases)):
        wanted = own.hash[own.first[k] : own.first[k + 1]]
        n = len(wanted)
        if not n or len(words.hash) < n:
            continue
        hit = np.flatnonzero(words.hash[: len(words.hash) - n + 1] == wanted[0])
        for i in range(1, n):
            hit = hit[words.hash[hit + i] == wanted[i]]
        hit = hit[words.row[hit] == words.row[hit + n - 1]]
        at.append(hit)
        which.append(np.full(len(hit), k))
    empty = np.zeros(0, np.int64)
    return np.concatenate(at or [empty]), np.concatenate(which or [empty])


DIGEST = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double"
)


def digests(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): base places and labels, and with ``labels`` those of found blocks too.

    ``score`` is 1 for a document with a base place, else the greatest containment of a found block, else 0.
    """
    index = Index.build(templates, frequencies(docs, templates), percent)

    def make():
        def step(batch):
            words = Words(batch.column("text"), SPACE)
            n = batch.num_rows
            at, which = places(words)
            row = words.row[at]
            local = at - words.first[row]
            found = index.search(words)
            score = np.zeros(n)
            np.maximum.at(score, found["row"], found["both"] / index.sizes[found["template"]])
            score[row] = 1.0
            first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            np.minimum.at(first, row, local)
            np.maximum.at(last, row, local)
            base: dict[int, set] = {}
            every: dict[int, set] = {}
            for r, k in zip(row.tolist(), which.tolist()):
                base.setdefault(r, set()).add(PHRASES[k][1])
                every.setdefault(r, set()).add(PHRASES[k][1])
            for r, t in zip(found["row"].tolist(), found["template"].tolist()):
                every.setdefault(r, set()).add(index.labels[t])
            none = last < 0
            return {
                "doc_id": batch.column("doc_id"),
                "n_words": np.diff(words.first),
                "n_base": np.bincount(row, minlength=n),
                "first_word": pa.array(first, pa.int64(), mask=none),
                "last_word": pa.array(last, pa.int64(), mask=none),
                "base_labels": [",".join(sorted(base.get(r, ()))) for r in range(n)],
                "labels": [",".join(sorted(every.get(r, ()))) for r in range(n)],
                "score": score,
            }

        return step

    return map_batches(docs.select("doc_id", "text"), DIGEST, make)
