"""Judgements on listings, pictures, payloads and paired lines on the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import listings
from ..operators import canonical, monitor, pictures, sharding
from ..sources import readers
from .registry import query, table


def _pick(number: Column, texts: list[str]) -> Column:
    """One of the texts by an id."""
    return F.element_at(F.array(*map(F.lit, texts)), (number % len(texts) + 1).cast("int"))


# --- titles -----------------------------------------------------------------------------------------------------------
@query("""
WITH w AS (SELECT o_orderkey, string_split(lower(CASE o_orderkey % 6 WHEN 0 THEN 'Lot of 3' WHEN 1 THEN 'Hobby box, sealed' WHEN 2 THEN 'Signed photo' WHEN 3 THEN 'Charlotte card' WHEN 4 THEN 'Game box lot' ELSE 'Boxer coin' END), ' ') AS w FROM orders)
SELECT o_orderkey, CASE WHEN list_contains(w, 'lot') THEN 'multi_card_or_lot' WHEN list_contains(w, 'sealed') THEN 'sealed_or_pack' WHEN list_contains(w, 'photo') OR list_contains(w, 'coin') THEN 'non_card_collectible' ELSE 'card_or_unknown' END AS kind FROM w
""")
def title_kinds(spark: SparkSession, d: str) -> DataFrame:
    title = _pick(F.col("o_orderkey"), ["Lot of 3", "Hobby box, sealed", "Signed photo", "Charlotte card", "Game box lot", "Boxer coin"])
    return table(spark, d, "orders").select("o_orderkey", listings.title_kind(title).alias("kind"))


SINGLES = [
    ("1952 Topps #311 PSA 8", True, False), ("T206 Cobb With Bat card SGC 3", True, False), ("1955 Bowman complete set of cards", False, True), ("Babe Ruth bat 1927 card", False, False),
    ("1989 Charlotte Hornets rookie card", True, False), ("2003 LeBron signed basketball #23", False, False), ("2003 LeBron signed basketball card #23", True, False), ("PSA 10 rookie", False, False),
    ("1986 Fleer wax box unopened", False, True), ("1939 Play Ball #26 DiMaggio", True, False), ("2020 Prizm RC (2)", False, True), ("1933 Goudey Bat Off Shoulder card", True, False),
]


@query("SELECT p_partkey, p_partkey % 12 IN (0, 1, 4, 6, 9, 11) AS single, p_partkey % 12 IN (2, 8, 10) AS is_set FROM part")
def single_cards(spark: SparkSession, d: str) -> DataFrame:
    title = _pick(F.col("p_partkey"), [t for t, _, _ in SINGLES])
    return table(spark, d, "part").select("p_partkey", listings.single_card(title).alias("single"), listings.names_set(title).alias("is_set"))


@query("""
WITH g AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'bgs' WHEN 1 THEN 'CGC' WHEN 2 THEN 'PSA' END AS c, CASE o_orderkey % 5 WHEN 0 THEN 10.0 WHEN 1 THEN 9.5 WHEN 2 THEN 8.0 WHEN 3 THEN 10.0 END AS g, o_orderkey % 3 = 0 AS special FROM orders)
SELECT o_orderkey, CASE WHEN g IS NULL THEN 'Ungraded' WHEN g = 10 AND c = 'bgs' AND special THEN 'BGS 10 Black' WHEN g = 10 AND c = 'CGC' AND special THEN 'CGC 10 Prist.' WHEN g = 10 AND c IS NOT NULL THEN upper(c) || ' 10' WHEN g = 9.5 THEN 'Grade 9.5' WHEN g = 8 THEN 'Grade 8' ELSE 'Grade 10' END AS label FROM g
""")
def grade_dialects(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    company = F.when(k % 4 == 0, "bgs").when(k % 4 == 1, "CGC").when(k % 4 == 2, "PSA")
    grade = F.when(k % 5 == 0, "10").when(k % 5 == 1, "9.5").when(k % 5 == 2, "8").when(k % 5 == 3, "10.0")
    title = F.when(k % 3 == 0, "x Black Label Pristine").otherwise("x")
    return table(spark, d, "orders").select("o_orderkey", listings.grade_dialect(company, grade, title).alias("label"))


# --- pictures ---------------------------------------------------------------------------------------------------------
@query("""
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'ok' WHEN 1 THEN 'other_host' WHEN 2 THEN 'other_route' WHEN 3 THEN 'unknown_source' WHEN 4 THEN 'bad_key' WHEN 5 THEN 'empty' ELSE 'ok' END AS state,
  CASE WHEN o_orderkey % 7 IN (0, 6) THEN 'a/' || CASE WHEN o_orderkey < 10 THEN lower('k' || o_orderkey) || '/__' ELSE 'k' || substr(o_orderkey::VARCHAR, 1, 1) || '/' || substr(o_orderkey::VARCHAR, 2, 2) END || '/K' || o_orderkey END AS stored_at FROM orders
""")
def picture_states(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    start = _pick(k, ["https://img.example.com/img/a/K", "https://other.example.com/img/a/K", "https://img.example.com/r/img/a/K", "https://img.example.com/img/z/K", "https://img.example.com/img/a/~K", "", " HTTPS://u@IMG.example.com:443/img/a/K"])
    url = F.when(start != "", F.concat(start, k, F.when(k % 7 == 6, "?w=1").otherwise("")))
    p = table(spark, d, "orders").select("o_orderkey", listings.picture(url, "img.example.com", ["a", "b"]).alias("p"))
    return p.select("o_orderkey", "p.state", F.when(F.col("p.key").isNotNull(), listings.shard_path(F.col("p.source"), F.col("p.key"))).alias("stored_at"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'bad_request' WHEN o_orderstatus = 'P' THEN 'curated_source' WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 'listed' ELSE 'unlisted' END AS reason,
  o_orderkey % 5 <> 0 AND (o_orderstatus = 'P' OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)) AS allowed FROM orders
""")
def public_decisions(spark: SparkSession, d: str) -> DataFrame:
    key = F.when(F.col("o_orderkey") % 5 == 0, "..").otherwise(F.col("o_custkey").cast("string"))
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("source"), key.alias("key"))
    listed = table(spark, d, "customer").filter("c_acctbal < 0").select(F.explode(F.array(F.lit("O"), F.lit("F"))).alias("source"), F.col("c_custkey").cast("string").alias("key"))
    return pictures.public(rows, listed, ["O", "F", "P"], ["P"]).select("o_orderkey", "reason", "allowed")


@query("""
WITH l AS (SELECT o_custkey, max_by(o_orderstatus, o_orderkey) AS s FROM orders GROUP BY o_custkey)
SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'other_route' WHEN s = 'P' THEN 'dead' WHEN s = 'F' THEN 'by_ledger' WHEN c_acctbal > 0 THEN 'by_store' ELSE 'not_stored' END AS state FROM customer LEFT JOIN l ON o_custkey = c_custkey
""")
def usable_pictures(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    url = F.concat(F.when(F.col("c_custkey") % 9 == 0, "http://x/").otherwise("http://p/"), F.col("c_custkey"), F.lit("/"))
    o = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("key"), "o_orderkey", F.replace(F.replace("o_orderstatus", F.lit("P"), F.lit("dead")), F.lit("F"), F.lit("ok")).alias("status"))
    stored = c.filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("key"))
    return pictures.usable(c.withColumn("url", url), monitor.latest(o, ["key"], ["o_orderkey"]), stored, "url", "http://p/").select("c_custkey", "state")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'http://a/' || o_custkey || ' http://b/1' WHEN o_orderkey % 3 = 1 THEN 'http://a/' || o_custkey ELSE 'http://b/1' END AS urls,
  CASE WHEN o_orderkey % 4 = 0 THEN 'https://m.example.com/first/' || o_custkey WHEN o_orderkey % 4 = 1 THEN 'https://m.example.com/now/' || o_custkey ELSE 'https://self/' || o_orderkey END AS listing FROM orders
""")
def picture_and_listing_urls(spark: SparkSession, d: str) -> DataFrame:
    k, a = F.col("o_orderkey"), F.concat(F.lit(" http://a/"), F.col("o_custkey"))
    lists = F.when(k % 3 == 0, F.array(a, F.lit("data:image/png;base64,x"), F.lit("http://b/1"))).when(k % 3 == 1, F.array(a, F.lit(" ")))
    urls = listings.picture_urls([lists], [F.when(k % 3 != 1, "http://b/1 "), F.when(k % 3 == 0, a)])
    kind = F.when(k % 4 == 0, "premier").when(k % 4 == 1, " FIXED").when(k % 4 == 2, "odd")
    made = listings.routed_url("https://m.example.com", {"PREMIER": "first", "FIXED": "now"}, kind, F.col("o_custkey").cast("string"), F.concat(F.lit("http://self/"), k))
    return table(spark, d, "orders").select("o_orderkey", F.array_join(urls, " ").alias("urls"), made.alias("listing"))


# --- payment, keys, details -------------------------------------------------------------------------------------------
@query("SELECT o_orderkey, o_orderstatus = 'P' AND o_orderkey % 2 = 0 AND date_diff('day', o_orderdate::DATE, DATE '1998-01-01') >= 7 AS void FROM orders")
def unpaid_sales(spark: SparkSession, d: str) -> DataFrame:
    sold = F.col("o_orderdate").cast("date")
    status, updated = F.when(F.col("o_orderstatus") == "P", "Unpaid"), F.when(F.col("o_orderkey") % 2 == 0, sold).otherwise(F.date_add(sold, 1))
    return table(spark, d, "orders").select("o_orderkey", listings.void_payment(status, sold, updated, F.lit("1998-01-01").cast("date")).alias("void"))


@query("""
SELECT o_orderkey FROM orders WHERE NOT (o_orderkey % 4 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)) AND o_orderkey % 10 <> 0
""")
def rows_without_seen_key(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    keys = listings.dedupe_keys({"id": F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey")), "url": F.lit(" ")}, F.col("o_orderkey"), F.lit(""), F.lit(None))
    by_id = table(spark, d, "customer").filter("c_custkey % 3 = 0").select(F.concat(F.lit("id:"), "c_custkey").alias("key"))
    by_title = o.filter("o_orderkey % 10 = 0").select(F.concat(F.lit("title_price_date:"), "o_orderkey", F.lit("||")).alias("key"))
    return canonical.without_seen(o, "o_orderkey", keys, by_id.unionByName(by_title)).select("o_orderkey")


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand WHEN p_partkey % 3 = 1 THEN p_type END AS player, CASE WHEN p_partkey % 2 = 0 THEN p_size::VARCHAR END AS number FROM part")
def promoted_details(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.when(k % 3 == 0, " Player ").when(k % 3 == 1, "ATHLETE").otherwise("artist")
    specifics = F.create_map(name, F.when(k % 3 == 1, F.concat(F.lit(" "), "p_type")).otherwise(F.col("p_brand")), F.lit("Card #"), F.when(k % 2 == 0, F.col("p_size").cast("string")).otherwise(" "))
    return table(spark, d, "part").select("p_partkey", listings.detail(specifics, "player", "athlete").alias("player"), listings.detail(specifics, "card number", "card #").alias("number"))


@query("SELECT l_orderkey, l_linenumber, l_partkey AS part, l_returnflag AS flag FROM lineitem WHERE l_orderkey % 10 <> 0")
def payload_rows(spark: SparkSession, d: str) -> DataFrame:
    """Line items of each order as one nested JSON text, some of them broken, and back."""
    item = F.struct(F.col("l_linenumber"), F.col("l_partkey").alias("part"), F.array(F.struct(F.lit("flag").alias("name"), F.col("l_returnflag").alias("value"))).alias("extra"))
    one = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("Sales"))
    text = F.to_json(F.struct(F.struct("Sales").alias("_embedded"), F.lit(1).alias("page")))
    texts = one.select("l_orderkey", F.when(F.col("l_orderkey") % 10 != 0, text).otherwise('{"_embedded": {"Sal').alias("body"))
    rows = readers.payload_records(texts, "body", ["_embedded", "Sales"], "l_linenumber int, part bigint, extra array<struct<name:string,value:string>>")
    return rows.select("l_orderkey", "l_linenumber", "part", listings.named_value(F.col("extra"), "flag").alias("flag"))


@query(r"""SELECT page_id, count(*) AS n, max(u) AS last_url FROM (SELECT page_id, unnest(regexp_extract_all(url || ' ' || html, 'https?://[^\s,"''<>]+')) AS u FROM pages) GROUP BY page_id""")
def free_text_urls(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").select("page_id", F.concat_ws(" ", "url", "html").alias("line"))
    return readers.urls_in(p, "line").groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.max("url").alias("last_url"))


# --- lines, bands, inserts --------------------------------------------------------------------------------------------
@query("""
WITH m AS (SELECT event_id, event_type = 'purchase' AS c, coalesce(sum((event_type = 'purchase')::INTEGER) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM events WHERE event_type IN ('signup', 'purchase')),
p AS (SELECT g, max(event_id) FILTER (NOT c) AS opened, max(event_id) FILTER (c) AS closed FROM m GROUP BY g)
SELECT opened, closed FROM p WHERE opened IS NOT NULL AND closed IS NOT NULL
""")
def paired_log_lines(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "event_type")
    return monitor.paired(e, [], "event_id", F.col("event_type") == "signup", F.col("event_type") == "purchase", F.floor(F.col("event_id") / 1000))


@query("""
WITH u AS (SELECT floor(l_quantity)::BIGINT AS lo, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT lo FROM u GROUP BY lo HAVING sum(n) > 40)
SELECT lo, lo + 1 AS hi, l_returnflag, n, CASE WHEN n > 40 THEN 2 ELSE 1 END AS passes, greatest(0, n - 80) AS residual FROM u JOIN t USING (lo)
""")
def dense_price_units(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_quantity", "l_returnflag")
    return sharding.split_dense(rows, sharding.bisect_shards(rows, "l_quantity", 40, 0, 64), "l_quantity", "l_returnflag", 40)


@query("""
SELECT count(DISTINCT o_custkey) FILTER (ok AND c_custkey IS NULL) AS n_new, count(*) FILTER (ok) - count(DISTINCT o_custkey) FILTER (ok AND c_custkey IS NULL) AS n_existing, count(*) FILTER (NOT ok) AS n_bad
FROM (SELECT *, o_orderstatus <> 'P' AS ok FROM orders) LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) ON o_custkey = c_custkey
""")
def insert_outcome(spark: SparkSession, d: str) -> DataFrame:
    have = table(spark, d, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return canonical.insert_counts(table(spark, d, "orders").select("o_custkey", "o_orderstatus"), have, ["o_custkey"], F.col("o_orderstatus") != "P")
