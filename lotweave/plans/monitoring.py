"""Audits, aggregates, windows, guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import joins, linking, monitor, sharding
from .registry import query, table

AS_OF = "2001-08-05"
#: Events of one key are cut into days, so that a busy key isn't one task.
DAY = "to_date(ts)"


@query("""
WITH v AS (SELECT source, lang, count(*) AS votes FROM documents WHERE source IS NOT NULL GROUP BY ALL),
w AS (SELECT *, sum(votes) OVER (PARTITION BY source) AS total, row_number() OVER (PARTITION BY source ORDER BY votes DESC, lang) AS rn FROM v)
SELECT source, lang, votes, total::BIGINT AS total, CASE WHEN votes / total >= 0.8 AND total >= 20 THEN 'MEDIUM' WHEN votes / total >= 0.5 AND total >= 5 THEN 'LOW' ELSE 'NONE' END AS confidence FROM w WHERE rn = 1
""")
def subject_majority_vote(spark: SparkSession, d: str) -> DataFrame:
    m = monitor.majority(table(spark, d, "documents"), "source", "lang")
    return m.select("source", "lang", "votes", "total", monitor.confidence(F.col("share"), F.col("total"), F.lit(None)).alias("confidence"))


@query("""
SELECT count(*) AS n_rows, count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality IS NULL) AS n_unlabelled, count(*) FILTER (toxic = 1) AS n_toxic, count(*) FILTER (n_chars > 5000) AS n_long FROM documents LEFT JOIN labels USING (doc_id)
""")
def audit_counters(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id", "left")
    return monitor.audit(j, {"n_good": F.col("quality") == 1, "n_unlabelled": F.col("quality").isNull(), "n_toxic": F.col("toxic") == 1, "n_long": F.col("n_chars") > 5000})


@query("SELECT mask, count(*) AS n_keys FROM (SELECT user_id, bit_or(CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 4 ELSE 8 END) AS mask FROM events GROUP BY user_id) GROUP BY mask")
def overlap_bitmask(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("event_type")
    return monitor.overlap_bitmask(table(spark, d, "events"), "user_id", F.when(t == "click", 1).when(t == "purchase", 2).when(t == "error", 4).otherwise(8))


@query("SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents) WHERE token NOT IN ('the', 'of', 'and') GROUP BY token HAVING count(*) >= 5")
def array_unnest_counts(spark: SparkSession, d: str) -> DataFrame:
    words = scalars.tokens(F.col("text"), "[a-z]+")
    return linking.token_counts(table(spark, d, "documents"), words, ["the", "of", "and"]).filter("n >= 5")


@query("""
WITH t AS (SELECT regexp_extract_all(lower(text), '[a-z]+') AS w FROM conversations), b AS (SELECT unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS bigram FROM t)
SELECT bigram, count(*) AS n FROM b GROUP BY bigram ORDER BY n DESC, bigram LIMIT 300
""")
def token_bigrams_topk(spark: SparkSession, d: str) -> DataFrame:
    grams = scalars.windows(scalars.tokens(F.col("text"), "[a-z]+"), 2)
    return linking.token_counts(table(spark, d, "conversations"), grams).withColumnRenamed("token", "bigram").orderBy(F.col("n").desc(), "bigram").limit(300)


@query("""
WITH m AS (SELECT l_partkey, median(l_extendedprice / l_quantity) AS med, count(*) AS n FROM lineitem GROUP BY l_partkey)
SELECT l.l_orderkey, l.l_linenumber, m.n AS n_sales, NOT (m.n >= 3 AND (l_extendedprice / l_quantity < med / 1.5 OR l_extendedprice / l_quantity > med * 1.5)) AS within FROM lineitem l JOIN m USING (l_partkey)
""")
def price_fence(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"))
    m = li.groupBy("l_partkey").agg(F.median("unit").alias("med"), F.count(F.lit(1)).alias("n_sales"))
    out = (F.col("n_sales") >= 3) & ((F.col("unit") < F.col("med") / 1.5) | (F.col("unit") > F.col("med") * 1.5))
    return li.join(m, "l_partkey").select("l_orderkey", "l_linenumber", "n_sales", (~out).alias("within"))


@query("SELECT p_brand, median(p_retailprice) AS mid, count(*) AS n FROM part GROUP BY p_brand")
def median_by_group(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(F.median("p_retailprice").alias("mid"), F.count(F.lit(1)).alias("n"))


@query("""
WITH e AS (SELECT p_brand, p_type, p_retailprice FROM part WHERE p_partkey % 10 = 0), r AS (SELECT p_partkey, p_brand, p_type FROM part WHERE p_partkey % 10 <> 0),
a AS (SELECT p_brand, p_type, max(p_retailprice) AS v FROM e GROUP BY ALL), b AS (SELECT p_brand, max(p_retailprice) AS v FROM e GROUP BY ALL)
SELECT p_partkey, coalesce(a.v, b.v) AS corroborated, CASE WHEN a.v IS NOT NULL THEN 0 WHEN b.v IS NOT NULL THEN 1 END AS level FROM r LEFT JOIN a USING (p_brand, p_type) LEFT JOIN b USING (p_brand)
""")
def corroboration_levels(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    return joins.corroborate(p.filter("p_partkey % 10 <> 0").drop("p_retailprice"), p.filter("p_partkey % 10 = 0"), [["p_brand", "p_type"], ["p_brand"]], "p_retailprice").select("p_partkey", "corroborated", "level")


@query(f"""
SELECT o_orderstatus, max(o_orderdate)::DATE::VARCHAR AS last_day, count(*) AS n_rows, date_diff('day', max(o_orderdate)::DATE, DATE '{AS_OF}')::INTEGER AS lag_days,
  CASE WHEN date_diff('day', max(o_orderdate)::DATE, DATE '{AS_OF}') > 60 THEN 'stale' WHEN date_diff('day', max(o_orderdate)::DATE, DATE '{AS_OF}') > 4 THEN 'late' ELSE 'fresh' END AS status FROM orders GROUP BY o_orderstatus
""")
def freshness_lag(spark: SparkSession, d: str) -> DataFrame:
    return monitor.freshness(table(spark, d, "orders"), "o_orderstatus", "o_orderdate", F.lit(AS_OF).cast("date"), 4, 60).withColumn("last_day", F.col("last_day").cast("string"))


@query("""
WITH c AS (SELECT l_partkey, max(n) AS top_count FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_partkey)
SELECT l_partkey, top_count, CASE WHEN top_count >= 4 THEN 'daily' WHEN top_count >= 2 THEN 'weekly' ELSE 'monthly' END AS tier FROM c
""")
def activity_tiers(spark: SparkSession, d: str) -> DataFrame:
    return monitor.activity_tiers(table(spark, d, "lineitem"), "l_partkey", "l_suppkey", [(4, "daily"), (2, "weekly")], "monthly")


@query("""
WITH e AS (SELECT *, (event_type = 'error')::INTEGER AS bad, sum((event_type <> 'error')::INTEGER) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
SELECT event_id, user_id, sum(bad) OVER (PARTITION BY user_id, island ORDER BY ts, event_id)::BIGINT AS streak FROM e
""")
def failure_streaks(spark: SparkSession, d: str) -> DataFrame:
    return monitor.streaks(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", F.expr(DAY)).select("event_id", "user_id", "streak")


@query("""
SELECT event_id, event_type, sum((value > 50)::INTEGER) OVER w::BIGINT AS recent_failures, count(*) OVER w >= 300 AND sum((value > 50)::INTEGER) OVER w > 120 AS stop FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 299 PRECEDING AND CURRENT ROW)
""")
def rolling_failure_ratio(spark: SparkSession, d: str) -> DataFrame:
    out = monitor.rolling_failures(table(spark, d, "events"), ["event_type"], ["ts", "event_id"], F.col("value") > 50, segment=F.expr(DAY))
    return out.select("event_id", "event_type", "recent_failures", "stop")


@query("""
WITH t AS (SELECT event_id, user_id, ts, CASE WHEN value >= 70 THEN true WHEN value <= 30 THEN false END AS turned FROM events)
SELECT event_id, coalesce(last_value(turned IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS latched FROM t
""")
def hysteresis_latch(spark: SparkSession, d: str) -> DataFrame:
    return monitor.latch(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("value"), 70, 30, F.expr(DAY)).select("event_id", "latched")


@query("""
WITH b AS (SELECT source, count(*) AS n_before FROM documents GROUP BY source), a AS (SELECT source, count(*) AS n_after FROM documents WHERE doc_id % 8 <> 0 GROUP BY source)
SELECT source, n_before, coalesce(n_after, 0) AS n_after, n_before >= 50 AND coalesce(n_after, 0) < n_before * (1 - 0.1::DOUBLE) AS refuse FROM b LEFT JOIN a USING (source)
""")
def shrink_guard(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source")
    return monitor.shrink_guard(docs, docs.filter("doc_id % 8 <> 0"), "source", 50)


@query("SELECT user_id, event_type, count(*) AS n_runs, max(event_id) AS last_at, max(event_id) FILTER (value > 50) AS last_done FROM events GROUP BY ALL")
def ledger_rollup(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("status", F.when(F.col("value") > 50, "completed").otherwise("failed"))
    return monitor.ledger_rollup(e, ["user_id", "event_type"], "status", "event_id", "completed")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return monitor.latest(table(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("SELECT event_type, count(*) FILTER (value > 80) AS n_bad, count(*) FILTER (value <= 80) AS n_good FROM events GROUP BY event_type")
def block_rate(spark: SparkSession, d: str) -> DataFrame:
    return monitor.rate(table(spark, d, "events"), ["event_type"], F.col("value") > 80, F.col("value") <= 80).drop("rate")


@query("""
WITH RECURSIVE u AS (SELECT floor(p_retailprice)::BIGINT AS u, count(*) AS n FROM part WHERE p_retailprice >= 0 AND p_retailprice < 4096 GROUP BY ALL),
s AS (SELECT 0::BIGINT AS lo, 4096::BIGINT AS hi, (SELECT sum(n) FROM u)::BIGINT AS n
  UNION ALL SELECT h.lo, h.hi, (SELECT sum(n) FROM u WHERE u.u >= h.lo AND u.u < h.hi)::BIGINT FROM (SELECT unnest([struct_pack(lo := lo, hi := (lo + hi) // 2), struct_pack(lo := (lo + hi) // 2, hi := hi)]) AS h FROM s WHERE n > 200 AND hi - lo > 1) x)
SELECT lo, hi, n, n > 200 AS open FROM s WHERE n IS NOT NULL AND (n <= 200 OR hi - lo <= 1)
""")
def shard_bisection(spark: SparkSession, d: str) -> DataFrame:
    return sharding.bisect_shards(table(spark, d, "part"), "p_retailprice", 200, 0, 4096)


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS qty, (sum(l_quantity::DECIMAL(18,2)) / sum(sum(l_quantity::DECIMAL(18,2))) OVER () >= 0.2) AS major FROM lineitem GROUP BY ALL")
def share_of_total(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(28,2)").alias("qty"))
    return g.withColumn("major", F.col("qty") / F.sum("qty").over(Window.partitionBy()) >= 0.2).withColumn("qty", F.col("qty").cast("double"))


def _sample(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "source").sample(0.1, seed=42)


def block_sample(spark: SparkSession, d: str) -> DataFrame:
    """A seeded sample of about a tenth of the rows: the feature itself is the sampling."""
    return _sample(spark, d)


query()(block_sample)
