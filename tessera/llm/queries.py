"""The registered queries of these operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_extraction, jaccard_join, licences, line_dedup, mixing, pieces, pii, quality_rules, token_counts, vector_search


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judged(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *(F.col(f"__measures.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.sanitise(table(spark, sf_dir, "documents")).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licences.scan(table(spark, sf_dir, "documents"))
    found = F.concat_ws(",", F.transform("matches", lambda m: F.concat_ws(":", m["licence"], m["start"].cast("string"), m["end"].cast("string"))))
    return out.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.concat_ws(",", "licences").alias("licences"), found.alias("matches"), F.concat_ws(",", "sentences").alias("sentences"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.main_texts(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared", "n_apart")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_vectors": op1_vectors,
        "op2_jaccard": op2_jaccard,
        "op3_tokens": op3_tokens,
        "op4_pieces": op4_pieces,
        "op5_quality": op5_quality,
        "op6_pii": op6_pii,
        "op7_lines": op7_lines,
        "op8_mixing": op8_mixing,
        "op9_licences": op9_licences,
        "op10_html": op10_html,
    }


_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP2 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
m AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT m.a, m.b FROM m JOIN n x ON x.doc_id = m.a JOIN n y ON y.doc_id = m.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""

_STOPS = ", ".join(f"'{w}'" for w in sorted({w for line in quality_rules.STOP_WORDS.values() for w in line.split()}))
OP5 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {_WORDS.format("t")} AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
x AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w),
y AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS k FROM x),
z AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM y WHERE k > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
  len(l) AS n_lines, len(list_filter(w, lambda q: lower(q) IN ({_STOPS}))) AS n_stop_words FROM w LEFT JOIN z ON z.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {" AND ".join(f"coalesce(({r.measure}) >= {r.low}, false)" for r in quality_rules.RULES if r.low is not None)} AND {" AND ".join(f"coalesce(({r.measure}) <= {r.high}, false)" for r in quality_rules.RULES if r.high is not None)} AS kept
FROM m
"""

OP7 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
o AS (SELECT k.*, c.last IS NOT NULL AND c.last <> k.doc_id AS gone FROM k LEFT JOIN c ON c.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM o GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard": OP2, "op5_quality": OP5, "op7_lines": OP7}
