"""The operators as registered queries over the given tables, with check SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from postweave.llm import decontaminate, jaccard, lexical, licenses, linechunks, lm, mixing, negatives, pii, quality, tokens, toxicity, webtext
from postweave.llm.common import new_folder, table


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.main_text(table(spark, sf_dir, "pages"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("found")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linechunks.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_chunks", "n_removed", "n_removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("found")).alias("spans"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.materialise(table(spark, sf_dir, "documents"), new_folder(spark, "shards"))[0]


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_source_mixing": op2_source_mixing,
    "op3_license_scan": op3_license_scan,
    "op4_decontamination": op4_decontamination,
    "op5_line_chunks": op5_line_chunks,
    "op6_personal_data": op6_personal_data,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_token_shards": op8_token_shards,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_quality_rules": op10_quality_rules,
    "op11_ranked_search": op11_ranked_search,
    "op12_toxicity": op12_toxicity,
    "op13_hard_negatives": op13_hard_negatives,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_SPACED = r"'[^\x20\x09-\x0D]+'"

_TEMPLATES = ", ".join(
    f"({t}, '{label}', string_split('{must}', ' '), string_split('{(must + ' ' + rest).strip()}', ' '))" for t, (label, must, rest) in enumerate(licenses.TEMPLATES)
)

ORACLES: dict[str, str] = {
    "op3_license_scan": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM documents),
tpl(t, label, must, whole) AS (VALUES {_TEMPLATES}),
occ AS (SELECT r, t, label, k, list_sum(list_transform(range(1, len(whole) + 1), lambda i: CASE WHEN w[k + i - 1] = whole[i] THEN 1 ELSE 0 END)) / len(whole) AS share
  FROM d, tpl, unnest(range(1, len(w) - len(must) + 2)) AS u(k) WHERE list_contains(w, must[1]) AND w[k:k + len(must) - 1] = must),
per AS (SELECT r, count(*) FILTER (t < {len(licenses.BASE)}) AS n_base, min(k - 1) FILTER (t < {len(licenses.BASE)}) AS first_word,
  max(k - 1) FILTER (t < {len(licenses.BASE)}) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (t < {len(licenses.BASE)}) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM occ GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN per USING (r)
""",
    "op5_line_chunks": """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
li AS (SELECT doc_id, k, l[k] AS line, md5(l[k]) AS h, md5(l[greatest(k - 1, 1)]) AS p,
  greatest(length(l[k]), length(l[greatest(k - 1, 1)])) >= 200 AS long FROM d, unnest(range(1, len(l) + 1)) AS u(k)),
c AS (SELECT *, sum(CASE WHEN k = 1 OR long OR substr(md5(p || h), 1, 1) < '4' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS nth FROM li),
ch AS (SELECT doc_id, nth, count(*) AS n, string_agg(line, chr(10) ORDER BY k) AS body FROM c GROUP BY doc_id, nth),
cand AS (SELECT *, regexp_matches(body, '[^\x20\x09-\x0D]') AS w, row_number() OVER (PARTITION BY body ORDER BY doc_id, nth) AS seen FROM ch),
gone AS (SELECT doc_id, nth, n FROM cand WHERE seen > 1 AND w AND (n >= 2 OR length(body) >= 200)),
per AS (SELECT doc_id, count(*) AS r, sum(n) AS rl FROM gone GROUP BY doc_id),
kept AS (SELECT c.doc_id, string_agg(line, chr(10) ORDER BY k) AS body FROM c ANTI JOIN gone g ON c.doc_id = g.doc_id AND c.nth = g.nth GROUP BY c.doc_id),
tot AS (SELECT doc_id, count(*) AS n_lines, max(nth) AS n_chunks FROM c GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_chunks, 0) AS BIGINT) AS n_chunks,
  CAST(coalesce(r, 0) AS BIGINT) AS n_removed, CAST(coalesce(rl, 0) AS BIGINT) AS n_removed_lines, sha256(coalesce(body, '')) AS kept_sha256
FROM documents LEFT JOIN tot USING (doc_id) LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op7_ngram_jaccard": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_SPACED}) AS w FROM documents),
g AS (SELECT DISTINCT doc_id, list_aggregate(w[k:k + least(3, len(w)) - 1], 'string_agg', ' ') AS s
  FROM d, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS u(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM g x JOIN g y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM c JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * m >= 90 * (p.n + q.n - m)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = d.doc_id), doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id)
""",
    "op4_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS id, regexp_extract_all({_LOWER.format("text")}, {_ALNUM}) AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
sized AS (SELECT id, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT id, n, list_aggregate(w[k:k + n - 1], 'string_agg', ' ') AS win
  FROM sized, unnest(range(1, len(w) - n + 2)) AS u(k)),
sizes AS (SELECT DISTINCT n FROM windows),
own AS (SELECT r, s.n, k, list_aggregate(w[k:k + s.n - 1], 'string_agg', ' ') AS win
  FROM d, sizes s, unnest(range(1, len(w) - s.n + 2)) AS u(k) WHERE len(w) >= s.n),
hits AS (SELECT r, k, own.n, id FROM own JOIN windows USING (n, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(k, k + n)) AS u(p) GROUP BY r),
ids AS (SELECT r, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS joined FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN ids USING (r)
""",
    "op11_ranked_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("text")}, {_ALNUM}) AS w FROM documents),
dn AS (SELECT *, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length FROM dn),
it AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, {_ALNUM})) AS t FROM benchmark WHERE item_id IS NOT NULL),
tf AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS t FROM dn) WHERE t IN (SELECT t FROM it) GROUP BY 1, 2),
wt AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s GROUP BY t, docs),
sc AS (SELECT item_id, doc_id, r, CAST(sum(wt.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS BIGINT) AS score
  FROM tf JOIN wt USING (t) JOIN it USING (t) JOIN dn USING (r), s GROUP BY 1, 2, 3)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM sc WHERE score > 0 QUALIFY rank <= 50
""",
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT row_number() OVER () AS k, * FROM (SELECT DISTINCT vec_id, label, q FROM v WHERE vec_id % 100 = 0)),
s AS (SELECT k, a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id, CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score FROM a, v),
p AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS place FROM s WHERE same AND vec_id IS DISTINCT FROM anchor_id QUALIFY place <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY k, place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s USING (k) WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score QUALIFY rank <= 5
""",
}
