"""The registered queries of this subpackage: each operator over its whole table, and DuckDB SQL where that can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exact, langid, licenses, mixing, neardup, packing, quality, tokens, topk

#: From this score on a document counts as good.
GOOD = 0.3
TOKEN_LIMIT = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op2_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, quality.label_bucket("doc_id", 5) != 0)
    out = quality.scored(docs, model)
    return out.select("doc_id", F.coalesce(quality.label_bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.dedup_exact(spark, f"{sf_dir}/documents.parquet")
    return rows.select(F.col("id").alias("doc_id"), F.col("keep.id").alias("keep_id"), "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = neardup.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = langid.fit(docs, quality.label_bucket("doc_id", 4) != 2)
    out = langid.predicted(docs, filters)
    return out.select("doc_id", F.coalesce(quality.label_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"), F.col("prediction.lang").alias("lang_pred"), F.col("prediction.score").alias("score"))


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "'</s>[INST] ok [/INST]'"
    extra = spark.sql(f"SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, {said} AS text FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = chat.read_back(chat.format_windows(turns))
    return read.select(
        "conv_id", "n_turns", F.sha2(F.col("turns"), 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text"), 256).alias("loss_sha256"), "formatted_chars"
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("und")), F.col("doc_id").cast("string"))
    out = licenses.scan(docs, path)
    return out.withColumnRenamed("id", "doc_id").drop("path")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter("id % 50 = 0"), k=5)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_harmonic(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_mix_sources, op2_quality_scores, op3_exact_dedup, op4_near_dedup, op5_language_id, op6_chat_windows, op7_license_scan, op8_exact_topk, op9_token_counts, op10_harmonic_packing]
    return {f.__name__: f for f in found}


_OP1 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 6))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM s),
o AS (SELECT *, cap / w AS full_at, 1.5::DOUBLE * (SELECT sum(source_size) FROM s) AS budget FROM w),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
f AS (SELECT level AS fill FROM l WHERE level <= full_at ORDER BY full_at, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT fill FROM f) * w, cap)) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
r2 AS (SELECT *, target - whole * source_size AS rest FROM r),
b AS (SELECT source, h, sum(size)::BIGINT AS size FROM d GROUP BY source, h),
c AS (SELECT b.source, b.h, r2.rest, sum(b.size) OVER (PARTITION BY b.source ORDER BY b.h) AS upto, b.size FROM b JOIN r2 ON b.source IS NOT DISTINCT FROM r2.source),
e AS (SELECT source, min(struct_pack(h := h, below := CASE WHEN rest - (upto - size) <= upto - rest THEN h ELSE h + 1 END)) AS edge FROM c WHERE upto > rest GROUP BY source)
SELECT d.doc_id, d.size, r2.source_size, r2.target,
       d.size * (r2.whole + CASE WHEN r2.rest > 0 AND d.h < coalesce(e.edge.below, 16777216) THEN 1 ELSE 0 END) AS taken
FROM d JOIN r2 ON d.source IS NOT DISTINCT FROM r2.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source
"""

_OP3 = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""

_OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, unnest(list_distinct([array_to_string(ws[i : i + 4], ' ') FOR i IN range(1, greatest(2, len(ws) - 3))])) AS g FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS id, a AS r FROM both_ways UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r),
label AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id, d.doc_id = coalesce(l.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN label l ON l.id = d.doc_id
"""

_REST = chat._REST.replace("'", "''")
_OP6 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
k AS (SELECT *, len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
             23 + length(role) + 1 + length(regexp_replace(body, '([<\[])(\\*)REST', '\1\2\\\3', 'g')) AS shown_length,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth FROM t),
h AS (SELECT conv_id, CASE WHEN role = 'system' THEN tokens ELSE 0 END AS st, CASE WHEN role = 'system' THEN shown_length ELSE 0 END AS sl FROM k WHERE nth = 1),
e AS (SELECT k.*, st, sl, nth = 1 AND role = 'system' AS is_system, sum(tokens) OVER (PARTITION BY k.conv_id ORDER BY nth) - st AS upto FROM k JOIN h ON k.conv_id = h.conv_id),
p AS (SELECT *, CASE WHEN upto <= 0 THEN 0 ELSE floor((upto - 1) / greatest(1, floor((1024 - st) / 2)))::BIGINT END AS span FROM e),
s AS (SELECT conv_id, span, sum(CASE WHEN is_system THEN 0 ELSE tokens END) AS span_tokens, max(st) AS st, max(sl) AS sl,
             min(upto) - arg_min(CASE WHEN is_system THEN 0 ELSE tokens END, upto) AS start FROM p GROUP BY conv_id, span),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY span) AS win, lead(start) OVER (PARTITION BY conv_id ORDER BY span) AS next_start,
             lead(greatest(0, least(256, 1024 - st - span_tokens))) OVER (PARTITION BY conv_id ORDER BY span) AS next_room FROM s),
c AS (SELECT p.conv_id, sum(shown_length + CASE WHEN NOT is_system AND next_start IS NOT NULL AND next_start - (upto - tokens) <= next_room THEN shown_length ELSE 0 END) AS chars
      FROM p JOIN n ON p.conv_id = n.conv_id AND p.span = n.span GROUP BY p.conv_id),
a AS (SELECT conv_id, sum(sl) AS chars FROM n WHERE win > 1 GROUP BY conv_id)
SELECT k.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(length(body)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(body, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (any_value(c.chars) + coalesce(any_value(a.chars), 0))::BIGINT AS formatted_chars
FROM k JOIN c ON c.conv_id = k.conv_id LEFT JOIN a ON a.conv_id = k.conv_id GROUP BY k.conv_id
"""

_OP8 = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
u AS (SELECT vec_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM v),
p AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score FROM u q JOIN u c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": _OP1, "op3_exact_dedup": _OP3, "op4_near_dedup": _OP4, "op6_chat_windows": _OP6.replace("REST", _REST), "op8_exact_topk": _OP8}
