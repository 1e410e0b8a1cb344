"""Registered queries of this subpackage and their DuckDB text where SQL expresses them."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import ann, decontaminate, language_id, license_scan, line_dedup, lm_scoring, near_dedup, packing, periodic_runs, secret_scan, token_alignment, token_counts, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # where the package isn't installed but found by path, Python workers find it there too
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_histogram(table(spark, sf_dir, "documents"))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def fold(column: str, n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(column).cast("string")) % n


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), learns=fold("id", 5) != 0)
    scores = toxicity.scored(docs, model)
    return scores.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"), F.sha2(F.col("__text"), 256).alias("text_sha256"))


ORACLE["op10_line_dedup"] = f"""
WITH d AS (SELECT doc_id, source, coalesce(source, '') AS host, text, string_split(text, chr(10)) AS ls FROM documents),
g AS (SELECT DISTINCT host, list_sort(list_distinct(list_filter(list_transform(ls, lambda x: trim(x)), lambda x: x <> ''))) AS page FROM d WHERE text IS NOT NULL),
t AS (SELECT host, count(*) AS pages FROM g GROUP BY host),
b AS (SELECT host, list(line) AS lines FROM (
  SELECT l.host, line FROM (SELECT host, unnest(page) AS line FROM g) AS l JOIN t USING (host) GROUP BY l.host, line, pages
  HAVING count(*) >= {line_dedup.LEAST_PAGES} AND count(*) > pages * {line_dedup.RATIO}) GROUP BY host),
k AS (SELECT doc_id, source, text, ls, CASE WHEN len(list_filter(ls, lambda x: list_contains(lines, trim(x)))) > 0
  THEN list_filter(ls, lambda x: trim(x) = '' OR NOT list_contains(lines, trim(x))) END AS kept FROM d LEFT JOIN b USING (host))
SELECT doc_id, source, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines,
  CAST(CASE WHEN kept IS NOT NULL THEN len(ls) - len(kept) ELSE 0 END AS BIGINT) AS n_dropped,
  sha256(CASE WHEN kept IS NOT NULL THEN coalesce(array_to_string(kept, chr(10)), '') ELSE text END) AS text_sha256 FROM k
"""


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.label(docs, language_id.learn(docs, learns=fold("id", 4) != 2))
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op8_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_scoring.score(table(spark, sf_dir, "documents"))
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).otherwise(0.0)
    return scores.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round(mean, 6).alias("mean_log_score"))


ORACLE["op1_lm_scoring"] = f"""
WITH w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents)),
g AS (SELECT doc_id, i, w AS g1, CASE WHEN i >= 2 THEN lag(w) OVER p || ' ' || w END AS g2,
  CASE WHEN i >= 3 THEN lag(w, 2) OVER p || ' ' || lag(w) OVER p || ' ' || w END AS g3,
  CASE WHEN i >= 2 THEN lag(w) OVER p END AS h1, CASE WHEN i >= 3 THEN lag(w, 2) OVER p || ' ' || lag(w) OVER p END AS h2
  FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
c1 AS (SELECT g1 AS g, count(*) AS c FROM g GROUP BY 1),
c2 AS (SELECT g2 AS g, count(*) AS c FROM g WHERE g2 IS NOT NULL GROUP BY 1),
c3 AS (SELECT g3 AS g, count(*) AS c FROM g WHERE g3 IS NOT NULL GROUP BY 1),
s AS (SELECT doc_id, CASE
    WHEN c3.c >= {lm_scoring.MIN_COUNT} THEN ln(c3.c) - ln(k2.c)
    WHEN c2.c >= {lm_scoring.MIN_COUNT} THEN CASE WHEN i >= 3 THEN ln({lm_scoring.ALPHA}) ELSE 0 END + ln(c2.c) - ln(k1.c)
    ELSE least(i - 1, 2) * ln({lm_scoring.ALPHA}) + ln(c1.c) - ln((SELECT count(*) FROM w)) END AS s
  FROM g JOIN c1 ON g1 = c1.g LEFT JOIN c2 ON g2 = c2.g LEFT JOIN c3 ON g3 = c3.g LEFT JOIN c1 AS k1 ON h1 = k1.g LEFT JOIN c2 AS k2 ON h2 = k2.g)
SELECT d.doc_id, coalesce(n, 0) AS n_words, round(coalesce(t, 0), 4) AS log_score, round(coalesce(t / n, 0), 6) AS mean_log_score
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n, sum(s) AS t FROM s GROUP BY 1) USING (doc_id)
"""


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.license_scan(table(spark, sf_dir, "documents")))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", periodic_runs.reshaped(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic_runs.digest(periodic_runs.periodic_runs(texts))


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.token_alignment(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op7_minhash_near_dedup"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({_LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS g FROM w),
x AS (SELECT doc_id, len(g) AS n, hash(unnest(g)) AS h FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x AS a JOIN x AS b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, least_id) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, r.least_id FROM r JOIN e ON r.doc_id = e.a),
c AS (SELECT doc_id, min(least_id) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""


def _found(kind: str, pattern: str, group: str = "") -> str:
    """SQL for (doc_id, kind, start, end, match, value) of each match: lengths of the texts between and of the matches before."""
    value = f"regexp_extract_all(t, '{pattern}', {group})" if group else "m"
    return f"""SELECT doc_id, {secret_scan.KINDS.index(kind) if kind in secret_scan.KINDS else 9} AS rank, '{kind}' AS kind, m[i] AS m, v[i] AS v,
    list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, {value} AS v, string_split_regex(t, '{pattern}') AS p FROM t))"""


_RUN = "[A-Za-z0-9+/_=-]{20,}"
_ALLOWED = " OR ".join(f"regexp_matches(m, '{p}')" for p in secret_scan.ALLOWED)
ORACLE["op2_secret_scan"] = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT * FROM ({_found("assign", secret_scan.ASSIGN.replace("'", "''"), "2")}) WHERE length(v) >= 8
  UNION ALL {_found("access", secret_scan.ACCESS_KEPT)} UNION ALL {_found("hex", "[0-9a-f]{32,}")}),
run AS (SELECT *, regexp_full_match(m, '[0-9a-fA-F]+') AS hex,
  list_max(list_transform(range(1, length(m) - 18), lambda i: list_entropy(string_split(substr(m, i, {secret_scan.WINDOW}), '')))) AS bits
  FROM ({_found("run", _RUN)}) WHERE NOT ({_ALLOWED})),
every AS (SELECT doc_id, rank, kind, s, s + length(m) AS e FROM base UNION ALL
  SELECT doc_id, CASE WHEN hex THEN 3 ELSE 4 END, CASE WHEN hex THEN 'hexrun' ELSE 'keyrun' END, s, s + length(m) FROM run
  WHERE bits >= CASE WHEN hex THEN {secret_scan.BITS["hexrun"]} ELSE {secret_scan.BITS["keyrun"]} END),
per AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n0, count(*) FILTER (rank = 1) AS n1, count(*) FILTER (rank = 2) AS n2,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS b, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS a
  FROM every GROUP BY doc_id)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM documents LEFT JOIN per USING (doc_id)
"""
