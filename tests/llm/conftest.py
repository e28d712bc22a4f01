from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta omega sigma river stone cloud field house green quiet seven table north paper light".split()


def prose(seed: int, count: int) -> str:
    """Sentences of invented words, different for each seed."""
    r = random.Random(seed)
    out, left = [], count
    while left > 0:
        n = min(left, r.randint(6, 14))
        words = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(n)]
        out.append(" ".join(words).capitalize() + ".")
        left -= n
    return " ".join(out)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang)."""

    def build(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1]) if r[1] else 0) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture
def odd(spark):
    """Rows that nothing may break on: nulls, empty and long texts, repeated rows, and columns with clashing names."""
    base = prose(1, 120)
    rows = [
        (1, base, "en"),
        (1, base, "en"),
        (2, base, None),
        (3, None, "en"),
        (4, "", "en"),
        (5, " \n\t ", None),
        (None, prose(2, 40), "en"),
        (7, "x" * 200_000, "en"),
        (8, prose(3, 20_000), "de"),
        (9, "12 34 !!! ???", "de"),
        (10, "word", "en"),
    ]
    df = spark.createDataFrame([(i, t, g, "s", len(t) if t else None) for i, t, g in rows], DOCS)
    return df.selectExpr(
        "*", "1 as n", "2 as node", "'a' as token", "3 as g", "4 as start", "'z' as gone", "5L as length", "true as target",
        "0 as h", "'q' as text_b", "7 as spans",
    )


@pytest.fixture
def none(docs):
    return docs((1, "a")).where("doc_id < 0")
