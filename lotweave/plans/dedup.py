"""Deduplication, incremental loads, joins, set operations, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import staging
from ..functions import scalars
from ..operators import canonical, joins, reconcile
from ..streaming import incremental
from ..streaming.state import disk_state
from .registry import query, table

CUT = "2024-01-02"


def _observations(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        F.concat(F.lit("EV:"), F.col("user_id")).alias("observation_id"), F.to_date("ts").alias("sold_date"), F.col("value").alias("sold_price_usd"), F.col("event_type").alias("discovery"),
        F.col("ts").alias("captured_at"), F.concat(F.lit("f"), F.col("event_id") % 3).alias("src_file"), F.col("event_id").alias("src_row"),
    )


@query("""
WITH o AS (SELECT 'EV:' || user_id AS observation_id, ts::DATE AS sold_date, value, event_type, ts, event_id FROM events),
g AS (SELECT observation_id, sold_date, count(*) AS n_observations, arg_min(struct_pack(v := value, t := event_type, e := event_id), struct_pack(a := value IS NULL, b := ts, c := event_id)) AS w,
  min(ts) AS lo, max(ts) AS hi, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS discovery_sources, count(DISTINCT round(value::DECIMAL(28,6), 2)) > 1 AS price_conflict FROM o GROUP BY ALL)
SELECT observation_id || ':' || coalesce(sold_date::VARCHAR, 'nodate') AS observation_key, observation_id, n_observations, w.e AS src_row, round(w.v::DECIMAL(28,6), 2)::DOUBLE AS price,
  discovery_sources, price_conflict, date_diff('second', lo, hi) AS span_seconds,
  CASE WHEN w.v IS NULL OR w.v <= 0 THEN 'no_price' WHEN price_conflict THEN 'price_conflict' ELSE 'ok' END AS gate FROM g
""")
def canonical_dedup_events(spark: SparkSession, d: str) -> DataFrame:
    rows = _observations(spark, d)
    order = [F.col("sold_price_usd").isNull(), F.col("captured_at"), F.col("src_row")]
    c = canonical.canonicalize(rows, order, {"discovery_sources": "discovery"}, {"price_conflict": scalars.cents(F.col("sold_price_usd"))})
    gate = F.when(F.col("sold_price_usd").isNull() | (F.col("sold_price_usd") <= 0), "no_price").when(F.col("price_conflict"), "price_conflict").otherwise("ok")
    span = F.timestamp_diff("SECOND", F.date_trunc("second", F.col("first_seen_at").cast("timestamp")), F.date_trunc("second", F.col("last_seen_at").cast("timestamp")))
    return c.select(canonical.observation_key().alias("observation_key"), "observation_id", "n_observations", "src_row", scalars.cents(F.col("sold_price_usd")).cast("double").alias("price"), F.array_join("discovery_sources", ",").alias("discovery_sources"), "price_conflict", span.alias("span_seconds"), gate.alias("gate"))


@query(f"""
WITH k AS (SELECT DISTINCT user_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS kind FROM events WHERE ts < TIMESTAMP '{CUT}'),
b AS (SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS kind FROM events WHERE ts >= TIMESTAMP '{CUT}')
SELECT event_id, user_id, kind FROM (SELECT b.*, row_number() OVER (PARTITION BY user_id, kind ORDER BY event_id) AS rn FROM b
  WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.user_id = b.user_id AND k.kind IS NOT DISTINCT FROM b.kind)) WHERE rn = 1
""")
def incremental_new_rows(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"))
    cut = F.lit(CUT).cast("timestamp_ntz")
    return canonical.new_rows(e.filter(F.col("ts") >= cut), e.filter(F.col("ts") < cut), ["user_id", "kind"], [F.col("event_id")]).select("event_id", "user_id", "kind")


@query("SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1")
def first_wins(spark: SparkSession, d: str) -> DataFrame:
    return canonical.first_wins(table(spark, d, "lineitem"), ["l_partkey"], [F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber")]).select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")


@query(f"""
WITH s AS (SELECT user_id, list('t:' || event_type) || list('p:' || props) FILTER (props IS NOT NULL) AS seen FROM events WHERE ts < TIMESTAMP '{CUT}' GROUP BY user_id),
b AS (SELECT user_id, list(struct_pack(e := event_id, k := list_filter(['t:' || event_type, 'p:' || props], lambda x: x IS NOT NULL)) ORDER BY event_id) AS todo FROM events WHERE ts >= TIMESTAMP '{CUT}' GROUP BY user_id),
r AS (SELECT b.user_id, list_reduce(list_transform(todo, lambda x: struct_pack(ids := [x.e], keys := x.k)),
  lambda acc, x: CASE WHEN list_has_any(acc.keys, x.keys) THEN acc ELSE struct_pack(ids := acc.ids || x.ids, keys := acc.keys || x.keys) END,
  struct_pack(ids := []::BIGINT[], keys := coalesce(seen, []::VARCHAR[]))) AS done FROM b LEFT JOIN s USING (user_id))
SELECT event_id, user_id, event_type FROM events WHERE event_id IN (SELECT unnest(done.ids) FROM r)
""")
def insert_one_by_one(spark: SparkSession, d: str) -> DataFrame:
    """What inserting later events one after another adds, ignoring those whose type or properties their user has already."""
    e, cut = table(spark, d, "events"), F.lit(CUT).cast("timestamp_ntz")
    out = canonical.insert_ignoring(e.filter(F.col("ts") >= cut), e.filter(F.col("ts") < cut), [["user_id", "event_type"], ["user_id", "props"]], [F.col("event_id")])
    return out.select("event_id", "user_id", "event_type")


@query("""
SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_orderkey < b.o_orderkey AND a.o_orderpriority = b.o_orderpriority
  AND abs(a.o_totalprice - b.o_totalprice) <= greatest(a.o_totalprice, b.o_totalprice) * 0.01 AND abs(date_diff('day', a.o_orderdate::DATE, b.o_orderdate::DATE)) <= 3 WHERE a.o_totalprice > 0 AND b.o_totalprice > 0
""")
def tolerance_self_join(spark: SparkSession, d: str) -> DataFrame:
    return joins.near_pairs(table(spark, d, "orders"), "o_orderkey", "o_totalprice", "o_orderdate", 1.0, 3, ["o_orderpriority"])


@query("""
WITH l AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0), r AS (SELECT * FROM orders WHERE o_orderkey % 2 = 1)
SELECT o_orderkey, o_custkey FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.o_custkey = l.o_custkey AND abs(date_diff('day', r.o_orderdate::DATE, l.o_orderdate::DATE)) <= 30)
""")
def tolerance_anti_join(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return joins.near_anti(o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 = 1"), ["o_custkey"], "o_orderdate", 30).select("o_orderkey", "o_custkey")


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS k FROM orders), c AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey END AS k FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT o_orderkey, EXISTS (SELECT 1 FROM c WHERE c.k IS NOT DISTINCT FROM o.k) AS known FROM o
""")
def semi_anti_null_keys(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("k"))
    c = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("k"))
    semi, anti = joins.semi_null_safe(o, c, ["k"]), joins.semi_null_safe(o, c, ["k"], "left_anti")
    return semi.select("o_orderkey", F.lit(True).alias("known")).unionByName(anti.select("o_orderkey", F.lit(False).alias("known")))


@query("""
WITH w AS (SELECT o_orderkey AS k, o_custkey AS t FROM orders WHERE o_orderkey % 3 <> 0), h AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 1 ELSE o_custkey END AS t, o_orderkey % 11 <> 0 AS v FROM orders WHERE o_orderkey % 4 <> 0)
SELECT coalesce(w.k, h.k) AS k, h.t AS from_target, w.t AS to_target, CASE WHEN h.k IS NULL THEN 'insert' WHEN w.k IS NULL THEN 'withdraw' WHEN w.t IS DISTINCT FROM h.t THEN 'repoint' WHEN NOT h.v THEN 'restore' ELSE 'keep' END AS action
FROM w FULL JOIN h ON w.k = h.k WHERE NOT (w.k IS NULL AND NOT h.v)
""")
def reconcile_diff(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("t"))
    have = o.filter("k % 4 <> 0").withColumn("v", F.col("k") % 11 != 0).withColumn("t", F.when(F.col("k") % 5 == 0, F.col("t") + 1).otherwise(F.col("t")))
    return reconcile.diff(o.filter("k % 3 <> 0"), have, "k", "t", "v")


@query("SELECT 'orders' AS source, o_orderkey AS id, NULL::BIGINT AS line, o_totalprice AS price, NULL::DOUBLE AS premium_pct FROM orders UNION ALL SELECT 'lineitem', l_orderkey, l_linenumber, l_extendedprice, l_tax FROM lineitem")
def union_by_name_missing_all(spark: SparkSession, d: str) -> DataFrame:
    specs = {
        "orders": {"id": F.col("o_orderkey"), "price": F.col("o_totalprice")},
        "lineitem": {"id": F.col("l_orderkey"), "line": F.col("l_linenumber").cast("long"), "price": F.col("l_extendedprice"), "premium_pct": F.col("l_tax")},
    }
    return canonical.normalize_sources({n: table(spark, d, n) for n in specs}, specs).select("source", "id", "line", "price", "premium_pct")


@query("""
WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'), b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error')
SELECT 'both' AS part, user_id FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'first', user_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'second', user_id FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
""")
def overlap_sets(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    a, b = e.filter("event_type = 'purchase'").select("user_id"), e.filter("event_type = 'error'").select("user_id")
    name = lambda df, n: df.select(F.lit(n).alias("part"), "user_id")
    return name(a.intersect(b), "both").union(name(a.distinct().join(b, "user_id", "left_anti"), "first")).union(name(b.distinct().join(a, "user_id", "left_anti"), "second"))


@query("""
WITH a AS (SELECT DISTINCT user_id AS k FROM events), b AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT (SELECT count(*) FROM a) AS n_first, (SELECT count(*) FROM b) AS n_second, (SELECT count(*) FROM a JOIN b USING (k)) AS n_both
""")
def cross_source_overlap(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "events").select(F.col("user_id").alias("k"), F.lit(1).alias("bit")), table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.lit(2).alias("bit"))
    masks = a.union(b).groupBy("k").agg(F.bit_or("bit").alias("m"))
    return masks.agg(F.count_if(F.col("m").bitwiseAND(1) > 0).alias("n_first"), F.count_if(F.col("m").bitwiseAND(2) > 0).alias("n_second"), F.count_if(F.col("m") == 3).alias("n_both"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def streaming_dedup_available_now(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream of files, deduplicated by its state on disk into a table."""
    out = staging.new_path(spark, "events-stream")
    path = f"{d}/events.parquet"
    whole = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    single = whole.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(whole).isFile()
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[t]" if single else path)
    rows = incremental.dedup_stream(stream.select("user_id", "event_type"), ["user_id", "event_type"])
    with disk_state(spark):
        rows.writeStream.format("parquet").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    return spark.read.parquet(f"{out}/rows")


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'old' END AS slug FROM orders)
SELECT o_orderkey, CASE WHEN slug IS NOT NULL THEN slug WHEN o_custkey % 2 = 0 THEN 'c' || o_custkey END AS slug, coalesce(slug IS NULL AND o_custkey % 2 = 0, false) AS tagged FROM o
""")
def guarded_tag_merge(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.create_map(F.lit("slug"), F.lit("old"))).alias("raw"))
    manifest = o.filter("o_custkey % 2 = 0").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey")).alias("value"))
    out = reconcile.merge_tags(o, manifest, "o_orderkey", "raw", "slug", "r1")
    return out.select("o_orderkey", F.try_element_at("raw", F.lit("slug")).alias("slug"), F.coalesce(F.try_element_at("raw", F.lit("slug_run")) == "r1", F.lit(False)).alias("tagged"))


@query("""
WITH old AS (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'id' || c_custkey END AS minted FROM customer WHERE c_custkey % 3 <> 0), new AS (SELECT c_custkey AS k, c_name || '!' AS name, 'new' || c_custkey AS minted FROM customer WHERE c_custkey % 4 <> 0)
SELECT coalesce(old.k, new.k) AS k, CASE WHEN new.k IS NOT NULL THEN new.name ELSE old.name END AS name, coalesce(old.minted, new.minted) AS minted FROM old FULL JOIN new ON old.k = new.k
""")
def upsert_mint_once(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    old = c.filter("k % 3 <> 0").withColumn("minted", F.when(F.col("k") % 2 == 0, F.concat(F.lit("id"), "k")))
    new = c.filter("k % 4 <> 0").select("k", F.concat("name", F.lit("!")).alias("name"), F.concat(F.lit("new"), "k").alias("minted"))
    return reconcile.upsert(old, new, "k", ["minted"])
