"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pensio.llm import (
    decontaminate,
    jaccard,
    language,
    licenses,
    lm,
    neighbours,
    packing,
    pii,
    quality,
    repetition,
    substring,
    toxicity,
    whitening,
)
from pensio.llm.common import documents, table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.whole_scores(documents(spark, sf_dir), lm.good_documents(table(spark, sf_dir, "labels")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.held_out_predictions(documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated(documents(spark, sf_dir))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.digests(documents(spark, sf_dir), repetition.planted)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digests(table(spark, sf_dir, "embeddings"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digests(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_lm_scoring,
        op2_language_id,
        op3_quality,
        op4_pii,
        op5_decontamination,
        op6_jaccard_join,
        op7_toxicity,
        op8_best_fit_packing,
        op9_substring_dedup,
        op10_embedding_dedup,
        op11_periodic_runs,
        op12_whitening,
        op13_license_scan,
    )
    return {f.__name__: f for f in own}


_LINKED = """
  SELECT {key}, {columns}, least({key}, coalesce((SELECT min(y) FROM reach WHERE x = {key}), {key})) AS component_id
  FROM   {source}"""

_REACH = """
  reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y)"""

#: All pairs that share a shingle, and reachability over the links: for small tables.
_JACCARD = (
    r"""
WITH RECURSIVE
  folded AS (SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w FROM documents),
  placed AS (SELECT doc_id, w, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [1]
                                           ELSE range(1, len(w) - 1) END) AS i FROM folded),
  shingle AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g FROM placed),
  size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
  shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
             FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
  link AS (SELECT x, y FROM shared JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
           WHERE 100 * o >= 90 * (a.n + b.n - o)),"""
    + _REACH
    + _LINKED.format(
        key="doc_id",
        columns="coalesce((SELECT n FROM size WHERE size.doc_id = d.doc_id), 0) AS n_shingles",
        source="documents d",
    )
)

_VECTORS = (
    """
WITH RECURSIVE
  usable AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
             WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND   len(list_filter(embedding, lambda x: x <> 0)) > 0),
  link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
           ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
           WHERE list_cosine_similarity(a.e, b.e) >= 0.93),"""
    + _REACH
    + """
SELECT *, vec_id = component_id AS kept FROM ("""
    + _LINKED.format(
        key="vec_id", columns="(SELECT count(*) FROM link WHERE x = vec_id) AS n_links", source="embeddings"
    )
    + ")"
)


#: Seeds by doubled grams, each met with its next occurrence; the longest row of seeds of one lag is a run.
_RUNS = r"""
WITH RECURSIVE
  hashed AS (SELECT doc_id, xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                               lambda x: CAST(ascii(x) AS BIGINT))),
               lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                  lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) AS h,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  cut AS (SELECT *, len(w) AS n, (h // 10) % len(w) AS a FROM hashed),
  part AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p, h % 10 = 0 AND n > 0 AS moved FROM cut),
  word AS (SELECT doc_id, i, n, w[1 + if(moved AND i >= a, a + (i - a) % p, i)] AS word
           FROM (SELECT *, unnest(range(n)) AS i FROM part)),
  five AS (SELECT doc_id, i, n, lead(i, 4) OVER one AS last,
                  [word, lead(word, 1) OVER one, lead(word, 2) OVER one, lead(word, 3) OVER one, lead(word, 4) OVER one] AS g
           FROM word WINDOW one AS (PARTITION BY doc_id ORDER BY i)),
  gram(doc_id, i, n, k, g) AS (
    SELECT doc_id, i, n, 5, dense_rank() OVER (ORDER BY g) FROM five WHERE last IS NOT NULL
    UNION ALL
    SELECT doc_id, i, n, 2 * k, dense_rank() OVER (ORDER BY g, more)
    FROM  (SELECT *, lead(g, CAST(k AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS more FROM gram WHERE n >= 4 * k)
    WHERE more IS NOT NULL),
  met AS (SELECT doc_id, i, k, lead(i) OVER (PARTITION BY doc_id, k, g ORDER BY i) - i AS q FROM gram),
  seed AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island
           FROM met WHERE q <= k AND (k = 5 OR q > k // 2)),
  run AS (SELECT doc_id, min(i) AS s, count(*) - 1 + k + q AS l, q FROM seed GROUP BY doc_id, q, k, island
          HAVING count(*) - 1 + k + q >= greatest(6, 4 * q)),
  best AS (SELECT doc_id, count(*) AS n_runs,
                  arg_min({'s': s, 'l': l, 'q': q}, {'a': -l, 'b': s, 'c': q}) AS b,
                  string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM run GROUP BY doc_id),
  gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM run),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t
           FROM word w WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = w.doc_id AND g.i = w.i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period,
       1000 * b.l // b.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(t, '')) AS collapsed_sha256
FROM   documents d LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _license_sql() -> str:
    """Every block of a document against every template, counted whole."""
    templates = ", ".join(
        f"({i}, '{label}', '{text.lower()}')" for i, (label, text) in enumerate(licenses.TEMPLATES)
    )
    phrases = ", ".join(f"('{phrase}', '{label}')" for phrase, label in licenses.PHRASES)
    step = licenses.step_of(licenses.TEMPLATES)
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"""
WITH
  template(t, label, text) AS (VALUES {templates}),
  template_pair AS (SELECT DISTINCT t, label, w[i] || ' ' || w[i + 1] AS g
                    FROM (SELECT *, unnest(range(1, len(w))) AS i
                          FROM (SELECT t, label, regexp_extract_all(text, {word}) AS w FROM template))),
  template_size AS (SELECT t, count(*) AS m FROM template_pair GROUP BY t),
  phrase(phrase, label) AS (VALUES {phrases}),
  folded AS (SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {word}) AS w
             FROM documents),
  placed AS (SELECT doc_id, i - 1 AS i, w[i] || ' ' || w[i + 1] AS two, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three
             FROM (SELECT *, unnest(range(1, len(w))) AS i FROM folded)),
  base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS l
           FROM placed JOIN phrase ON phrase IN (two, three) GROUP BY doc_id),
  paired AS (SELECT doc_id, i, t, label, g FROM placed JOIN template_pair ON g = two),
  blocked AS (SELECT *, i // {step} AS b FROM paired
              UNION ALL SELECT *, i // {step} - 1 AS b FROM paired WHERE i >= {step} AND i % {step} < {step} - 1),
  shared AS (SELECT doc_id, t, label, b, count(DISTINCT g) AS o FROM blocked GROUP BY ALL),
  hit AS (SELECT doc_id, max(CAST(o AS DOUBLE) / m) AS score, list(DISTINCT label) AS l
          FROM shared JOIN template_size USING (t) WHERE 100 * o >= {licenses.PERCENT} * m GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(base.l, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.l, []), coalesce(hit.l, [])))), ',') AS labels,
       if(n_base IS NOT NULL, 1.0::DOUBLE, coalesce(hit.score, 0.0)) AS score
FROM   folded LEFT JOIN base USING (doc_id) LEFT JOIN hit USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_jaccard_join": _JACCARD,
        "op10_embedding_dedup": _VECTORS,
        "op11_periodic_runs": _RUNS,
        "op13_license_scan": _license_sql(),
    }
