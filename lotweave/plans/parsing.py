"""Parsing, normalizing, gating, classifying."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, scalars
from ..operators import canonical, linking, mappers
from ..sources import readers
from .registry import query, table


@query("""
SELECT o_orderkey, round(o_totalprice::DECIMAL(28,6), 2)::DOUBLE AS price, o_orderkey % 10 = 0 AS blank FROM orders WHERE o_orderkey % 10 <> 0 UNION ALL SELECT o_orderkey, NULL, true FROM orders WHERE o_orderkey % 10 = 0
""")
def normalize_price_text(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 10 == 0, "best offer").otherwise(F.concat(F.lit("$"), F.format_number(scalars.cents(F.col("o_totalprice")), 2)))
    return o.select("o_orderkey", scalars.price_decimal(text).cast("double").alias("price"), (F.col("o_orderkey") % 10 == 0).alias("blank"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE o_orderdate::DATE::VARCHAR END AS sold FROM orders")
def sold_date_formats(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.concat(F.lit("Sold "), F.date_format("day", "MMM d, yyyy"))).when(k == 1, F.date_format("day", "MMMM d, yyyy")).when(k == 2, F.concat(F.col("day").cast("string"), F.lit("T10:00:00Z"))).otherwise("garbage")
    return o.select("o_orderkey", scalars.sold_date(text).cast("string").alias("sold"))


@query(r"""
SELECT page_id, nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#:]+)', 1)), '') AS host, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm,
  nullif(regexp_extract(url, '/([0-9]+)(?:\.html)?/?(?:[?#].*)?$', 1), '') AS item FROM pages
""")
def url_host_and_id(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", scalars.host(u).alias("host"), scalars.query_param(u, "utm_source").alias("utm"), scalars.match(u, r"/([0-9]+)(?:\.html)?/?(?:[?#].*)?$").alias("item"))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_extract_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("""
SELECT p_partkey, CASE WHEN p_retailprice IS NULL OR p_retailprice <= 0 THEN 'no_price' WHEN regexp_matches(lower(p_name), '(^|[^A-Za-z0-9_])(lot|lots|bundle|bulk|set of [0-9]+)([^A-Za-z0-9_]|$)') THEN 'lot_bundle'
  WHEN p_partkey % 6 = 0 THEN 'obo' ELSE 'ok' END AS gate FROM part
""")
def valuation_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", canonical.valuation_gate(F.col("p_name"), F.col("p_retailprice"), F.col("p_partkey") % 6 == 0).alias("gate"))


_RULES = [("license", "(licensed|released) under"), ("symbols", r"[a-z][$%&#*]{3}"), ("table", r" \| "), ("shout", "[A-Z]{4,}!!")]


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '(licensed|released) under') THEN 'license' WHEN regexp_matches(text, '[a-z][$%&#*]{3}') THEN 'symbols' WHEN regexp_matches(text, ' \\| ') THEN 'table' WHEN regexp_matches(text, '[A-Z]{4,}!!') THEN 'shout' ELSE 'prose' END AS kind FROM documents".replace("\\\\", "\\"))
def classify_first_match(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", rules.first_match(F.col("text"), _RULES, "prose").alias("kind"))


@query("""
SELECT doc_id, array_to_string(list_filter([CASE WHEN n_chars < 500 THEN 'short' END, CASE WHEN n_chars > 5000 THEN 'long' END, CASE WHEN contains(text, '@') THEN 'mail' END, CASE WHEN lang <> 'en' THEN 'foreign' END], lambda x: x IS NOT NULL), ',') AS reasons FROM documents
""")
def reject_reasons(spark: SparkSession, d: str) -> DataFrame:
    cases = [(F.col("n_chars") < 500, "short"), (F.col("n_chars") > 5000, "long"), (F.col("text").contains("@"), "mail"), (F.col("lang") != "en", "foreign")]
    return table(spark, d, "documents").select("doc_id", F.array_join(rules.all_reasons(cases), ",").alias("reasons"))


_EDGES, _NAMES = [1000, 50000, 150000, 300000], ["tiny", "low", "mid", "high", "top"]


@query("SELECT CASE WHEN o_totalprice < 1000 THEN 'tiny' WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice < 150000 THEN 'mid' WHEN o_totalprice < 300000 THEN 'high' ELSE 'top' END AS band, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY ALL")
def price_bands_by_month(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.groupBy(rules.bands(F.col("o_totalprice"), _EDGES, _NAMES).alias("band"), scalars.month_of(F.col("o_orderdate")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""
SELECT page_id, (i - 1)::INTEGER AS pos, h[i] AS href, t[i] AS label FROM (SELECT page_id, h, t, unnest(range(1, len(h) + 1)) AS i FROM
  (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>', 1) AS h, regexp_extract_all(html, '<a [^>]*href="[^"]*"[^>]*>([^<]*)<', 1) AS t FROM pages))
""")
def html_links(spark: SparkSession, d: str) -> DataFrame:
    return readers.links(table(spark, d, "pages").select("page_id", "html"))


@query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, trim(regexp_replace(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '<[^>]+>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) AS heading FROM pages")
def html_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), scalars.strip_tags(F.regexp_extract("html", "<h1>(.*?)</h1>", 1)).alias("heading"))


@query(r"""
SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, sha1(p_name || '|' || p_brand) AS sha, substr(sha256(p_type), 1, 12) AS short FROM part
""")
def slug_and_hash_ids(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", scalars.slug(F.col("p_name")).alias("slug"), F.split_part(scalars.stable_id("P", F.col("p_name"), F.col("p_brand")), F.lit(":"), F.lit(2)).alias("sha"), F.substring(F.sha2("p_type", 256), 1, 12).alias("short"))


@query(r"""
SELECT doc_id, translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy') AS folded FROM documents
""")
def fold_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", scalars.fold_latin(F.col("text")).alias("folded"))


@query(r"""
WITH t AS (SELECT o_orderkey, (1950 + o_orderkey % 70) || ' Topps #' || (o_orderkey % 500) || ' PSA ' || (o_orderkey % 10 + 1) || ' ' || (o_orderkey % 90 + 1) || '/99' AS title FROM orders)
SELECT o_orderkey, (1950 + o_orderkey % 70)::INTEGER AS year, (o_orderkey % 500)::VARCHAR AS number, (o_orderkey % 90 + 1)::INTEGER AS serial, 99 AS print_run, 'PSA ' || (o_orderkey % 10 + 1) AS grade FROM t
""")
def title_parsing(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    title = F.concat((k % 70 + 1950).cast("string"), F.lit(" Topps #"), (k % 500).cast("string"), F.lit(" PSA "), (k % 10 + 1).cast("string"), F.lit(" "), (k % 90 + 1).cast("string"), F.lit("/99"))
    t = table(spark, d, "orders").select("o_orderkey", title.alias("title"))
    p = linking.parse_title(F.col("title"))
    return t.select("o_orderkey", p["year"].alias("year"), p["number"].alias("number"), p["serial"].alias("serial"), p["print_run"].alias("print_run"), linking.grade_label(p["grader"], p["grade"]).alias("grade"))


# --- texts in many spellings, read by either engine's own functions ------------------------------------------------------
_PRICES = "CASE o_orderkey % 9 WHEN 0 THEN '$1,234.50' WHEN 1 THEN '70.0 to 80.0' WHEN 2 THEN '-$5' WHEN 3 THEN '' WHEN 4 THEN 'free' WHEN 5 THEN 'US $12.3' WHEN 6 THEN '$ 1 000' WHEN 7 THEN '.5' ELSE '£' || o_totalprice END"


@query(rf"SELECT o_orderkey, try_cast(nullif(regexp_extract(regexp_replace({_PRICES}, '[$,\s]', '', 'g'), '-?[0-9]+(\.[0-9]+)?'), '') AS DOUBLE) AS price FROM orders")
def parsed_prices(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", scalars.price(F.expr(_PRICES)).alias("price"))


_AMOUNTS = "CASE o_orderkey % 7 WHEN 0 THEN 'est. $5, sold for $1.5 million' WHEN 1 THEN '$2k then $ 3,000' WHEN 2 THEN 'no amount' WHEN 3 THEN '$7B!' WHEN 4 THEN '$12.75 m' WHEN 5 THEN 'from $9 up' ELSE 'Sold: $' || o_custkey || '.50' END"


@query(rf"""
WITH t AS (SELECT o_orderkey, list_last(regexp_extract_all(lower({_AMOUNTS}), '\$\s*([0-9][0-9,]*(?:\.[0-9]+)?\s*(?:million|billion|k|m|b)?)', 1)) AS a FROM orders)
SELECT o_orderkey, try_cast(replace(regexp_extract(a, '[0-9][0-9,]*(?:\.[0-9]+)?'), ',', '') AS DOUBLE) * CASE trim(regexp_replace(a, '[0-9.,]', '', 'g')) WHEN 'k' THEN 1000.0 WHEN 'm' THEN 1000000.0 WHEN 'million' THEN 1000000.0 WHEN 'b' THEN 1000000000.0 WHEN 'billion' THEN 1000000000.0 ELSE 1.0 END AS money FROM t
""")
def parsed_amounts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", scalars.last_money(F.expr(_AMOUNTS)).alias("money"))


_DAYS = ["'Sold ' || {m} ", "{M} ", "'ended: ' || {m} ", "{iso} ", "{iso} || 'T10:00:00Z' ", "{us} ", "'soon' "]


def _days(short: str, long: str, iso: str, us: str) -> str:
    return "CASE o_orderkey % 7 " + " ".join(f"WHEN {i} THEN {t.format(m=short, M=long, iso=iso, us=us)}" for i, t in enumerate(_DAYS)) + "END"


_SQL_DAYS = _days("strftime(o_orderdate, '%b %-d, %Y')", "strftime(o_orderdate, '%B %-d, %Y')", "strftime(o_orderdate, '%Y-%m-%d')", "strftime(o_orderdate, '%-m/%-d/%Y')")
_SPARK_DAYS = _days("date_format(o_orderdate, 'MMM d, yyyy')", "date_format(o_orderdate, 'MMMM d, yyyy')", "date_format(o_orderdate, 'yyyy-MM-dd')", "date_format(o_orderdate, 'M/d/yyyy')")


@query(rf"""
WITH t AS (SELECT o_orderkey, {_SQL_DAYS} AS t FROM orders), p AS (SELECT *, trim(regexp_replace(t, '^\s*(sold|ended)\s*:?\s*', '', 'i')) AS p FROM t)
SELECT o_orderkey, coalesce(try_strptime(p, ['%b %d, %Y', '%B %d, %Y'])::DATE, CASE WHEN regexp_matches(p, '^\d{{4}}-\d{{2}}-\d{{2}}') THEN try_cast(p[1:10] AS DATE) END)::VARCHAR AS sold, try_strptime(nullif(regexp_extract(t, '\d{{1,2}}/\d{{1,2}}/\d{{4}}'), ''), '%m/%d/%Y')::DATE::VARCHAR AS us FROM p
""")
def parsed_days(spark: SparkSession, d: str) -> DataFrame:
    t = F.expr(_SPARK_DAYS)
    return table(spark, d, "orders").select("o_orderkey", scalars.sold_date(t).cast("string").alias("sold"), scalars.us_date(t).cast("string").alias("us"))


@query(r"""
SELECT page_id, 'https://' || lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#:]+)', 1)) || regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]+([^?#]*)', 1), '/+$', '') AS canonical,
  nullif(regexp_replace(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]+[^?#]*)', 1), '/+$', ''), '') AS plain FROM pages
""")
def address_forms(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", scalars.canonical_url(u).alias("canonical"), mappers.plain_url(u).alias("plain"))


@query(r"""
WITH s AS (SELECT p_partkey, trim(regexp_replace(lower(p_name || ' No.' || p_size), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM part)
SELECT p_partkey, array_to_string(list_transform(string_split(s, '-'), lambda w: upper(w[1]) || w[2:]), ' ') AS words, regexp_replace(lower('0' || p_partkey || '-A'), '[^a-z0-9]', '', 'g')[2:] AS number_key,
  CASE WHEN p_partkey % 2 = 0 THEN 'c' || p_partkey ELSE 'c' || p_partkey END AS family FROM s JOIN part USING (p_partkey)
""")
def names_and_keys(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    s = scalars.slug(F.concat("p_name", F.lit(" No."), "p_size"))
    card = F.concat(F.lit("c"), k, F.when(k % 2 == 0, "~gold").otherwise(""))
    return table(spark, d, "part").select("p_partkey", scalars.words_from_slug(s).alias("words"), F.regexp_replace(scalars.number_key_plain(F.concat(F.lit("0"), k, F.lit("-A"))), "^0", "").alias("number_key"), linking.family(card).alias("family"))


@query("""
SELECT o_orderkey, round((o_totalprice * (1 + CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 20 END / 100.0::DOUBLE))::DECIMAL(28,6), 2)::DOUBLE AS paid, date_diff('second', o_orderdate, TIMESTAMP '2001-01-01') / 3600.0::DOUBLE AS age,
  CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE 'unknown' END AS lane FROM orders
""")
def premiums_ages_and_stamps(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").withColumn("lane", F.when(k % 4 == 0, F.col("o_orderpriority")).when(k % 4 == 1, " "))
    paid = scalars.with_premium(F.col("o_totalprice"), F.when(k % 3 != 0, 20.0)).cast("double")
    age = scalars.age_hours(F.col("o_orderdate").cast("timestamp"), F.lit("2001-01-01").cast("timestamp"))
    return canonical.stamp(o, lane="unknown").select("o_orderkey", paid.alias("paid"), age.alias("age"), "lane")


@query("SELECT event_id FROM events WHERE event_id % 6 = 0 OR ts >= TIMESTAMP '2024-01-20'")
def rows_from_mark(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 6 != 0, F.col("ts").cast("timestamp_ntz")).alias("at"))
    return readers.read_after(e, "at", F.lit("2024-01-20").cast("timestamp_ntz")).select("event_id")
