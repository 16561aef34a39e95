"""Sources, categories, sales and their audits on the test tables. Texts are made by one expression that both engines run, so the SQL reads them too."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cards, categories, listings, rules, scalars
from ..operators import canonical, ledger, linking, mappers, monitor, sales, sharding, states
from ..streaming import incremental
from .registry import query, table


def _case(number: str, texts: list[str]) -> str:
    """An SQL expression for one of the texts by a number; the same in both engines."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    return f"CASE {number} % {len(texts)} " + " ".join(f"WHEN {i} THEN {quoted(t)}" for i, t in enumerate(texts)) + " END"


def _spark(expr: str) -> Column:
    """Such an expression in Spark, whose literals double quotes by a backslash."""
    return F.expr(re.sub(r"(?<=\w)''(?=\w)", r"\\'", expr))


# --- categories -------------------------------------------------------------------------------------------------------
MARKET = [
    "Charizard VMAX", "1999 Base Set Shadowless", "Yu-Gi-Oh Exodia", "Mox Ruby", "Lorcana foil", "1921 Morgan Dollar", "25 coin roll", "coins lot of ten", "MS-65 gold", "Rolex 1680",
    "CGC 9.8 comic", "X-Men #1", "Funko Pop", "NES game", "Lakers rookie", "Prizm Basketball #7", "NFL Draft", "Bowman 1st", "Young Guns", "Euro 2024 sticker", "A'ja Wilson auto",
    "UFC Jon Jones", "F1 chrome", "PGA", "Wimbledon", "Mike Tyson", "Yankees cap", "Red Wings", "Topps Finest lot", "Black Diamond card", "Gold Standard", "plain widget", "snes", "OPC rookie",
]
_MARKET = "lower(p_name || ' ' || " + _case("p_partkey", MARKET) + ")"


@query(f"""
WITH t AS (SELECT p_partkey, {_MARKET} AS t FROM part)
SELECT p_partkey, {rules.sql_case("t", categories.CATEGORY_RULES, "sports")} AS category, {rules.sql_case("t", categories.SPORT_RULES)} AS sport, {rules.sql_case("t", categories.LEANING_RULES)} AS leaning FROM t
""")
def market_categories(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "part").select("p_partkey", _spark(_MARKET).alias("t"))
    named = {"category": rules.first_match(F.col("t"), categories.CATEGORY_RULES, "sports"), "sport": rules.first_match(F.col("t"), categories.SPORT_RULES), "leaning": rules.first_match(F.col("t"), categories.LEANING_RULES)}
    return t.select("p_partkey", *[c.alias(n) for n, c in named.items()])


def _sql_keyword(text: str, lists: dict[str, list[str]], default: str) -> str:
    quoted = lambda k: "'" + k.replace("'", "''") + "'"
    cases = " ".join(f"WHEN {' OR '.join(f'contains({text}, {quoted(k)})' for k in terms)} THEN '{name}'" for name, terms in lists.items())
    return f"CASE {cases} ELSE '{default}' END"


@query(f"""
WITH t AS (SELECT p_partkey, {_MARKET} AS t FROM part)
SELECT p_partkey, {_sql_keyword("t || ' ' || lower(p_type) || ' '", categories.KEYWORD_CATEGORIES, "sports")} AS category, {_sql_keyword("' ' || t || ' ' || lower(p_type) || ' '", categories.KEYWORD_SPORTS, "unknown")} AS sport FROM t JOIN part USING (p_partkey)
""")
def keyword_categories(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "part").select("p_partkey", "p_type", _spark(_MARKET).alias("t"))
    return t.select("p_partkey", categories.category_by_keyword(F.col("t"), F.col("p_type")).alias("category"), categories.sport_by_keyword(F.col("t"), F.col("p_type")).alias("sport"))


FLAGGED = ["Lot of 3 packs", "Sealed box", "Case break", "Custom reprint", "Digital card", "non-card poster", "Lots of pins", "pilot lottery", "Sticker only", "plain", "noncard Photo", "boxer breaker"]
_FLAGGED = "p_name || ' ' || " + _case("p_partkey", FLAGGED)


@query(f"""
WITH t AS (SELECT p_partkey, ' ' || regexp_replace(lower({_FLAGGED}), '[^a-z0-9]+', ' ', 'g') || ' ' AS t FROM part)
SELECT p_partkey, array_to_string(list_filter([{", ".join(f"CASE WHEN {' OR '.join(f'''contains(t, ' {w} ')''' for w in terms)} THEN '{name}' END" for name, terms in listings.TITLE_FLAGS.items())}], lambda x: x IS NOT NULL), ',') AS flags FROM t
""")
def title_flag_lists(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.array_join(listings.title_flags(_spark(_FLAGGED)), ",").alias("flags"))


NAMED_HOUSES = ["Heritage sells", "A great area", "REA fall", "PWCC", "Breannan", "mile high, iconic", "Robert Edward", "none", "RR Auction & Lelands", "sterling"]
_HOUSE = "p_name || ' ' || " + _case("p_partkey", NAMED_HOUSES)


@query(f"""SELECT p_partkey, {rules.sql_case(f"lower({_HOUSE})", [(label, rules.any_word([name])) for name, label in mappers.HOUSES], "")} AS house FROM part""")
def house_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", mappers.house(_spark(_HOUSE)).alias("house"))


# --- sources ----------------------------------------------------------------------------------------------------------
@query("""
WITH o AS (SELECT *, o_orderdate::DATE AS day FROM orders)
SELECT 'goldin' AS source, 'L' || o_orderkey AS source_item_id, round(o_totalprice * (1 + CASE WHEN o_orderkey % 2 = 0 THEN 20 ELSE 0 END / 100.0::DOUBLE), 2) AS sold_price, day::VARCHAR AS sold_date, NULL AS set_name FROM o WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0
UNION ALL SELECT 'tcgplayer', o_custkey || ':' || CASE WHEN o_orderkey % 3 = 0 THEN day::VARCHAR ELSE 'T' || o_orderkey END, o_totalprice, day::VARCHAR, o_orderpriority FROM o WHERE o_orderkey % 7 <> 0
UNION ALL SELECT 'myslabs', 'https://m/slab/view/' || o_orderkey, o_totalprice, day::VARCHAR, NULL FROM o WHERE o_orderkey % 4 <> 0
UNION ALL SELECT 'rea', 'https://r/' || o_orderkey, o_totalprice, day::VARCHAR, NULL FROM o WHERE o_orderkey % 3 <> 0
""")
def mapped_sources(spark: SparkSession, d: str) -> DataFrame:
    """Orders as the landed records of four sources, some of them broken, through each source's mapper."""
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").withColumns({"day": F.col("o_orderdate").cast("date").cast("string"), "price": F.col("o_totalprice").cast("string")})
    raws = {
        "goldin": o.select(F.concat(F.lit("L"), k).alias("lot_id"), F.when(k % 7 != 0, F.col("price")).alias("sold_price"), F.when(k % 5 == 0, "n/a").when(k % 2 == 0, "20").alias("buyer_premium_pct"), F.when(k % 11 != 0, F.col("day")).alias("sold_date")),
        "tcgplayer": o.select(F.col("o_custkey").alias("product_id"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("T"), k)).alias("order_ts"), F.when(k % 7 != 0, F.col("price")).alias("sold_price"), F.col("day").alias("sold_date"), F.col("o_orderpriority").alias("set_name")),
        "myslabs": o.select(F.when(k % 4 == 0, "https://m/slab/view//").otherwise(F.concat(F.lit("https://m/slab/view/"), k)).alias("url"), F.col("price").alias("sold_price"), F.col("day").alias("sold_date")),
        "rea": o.select(F.when(k % 3 != 0, F.concat(F.lit("https://r/"), k)).alias("url"), F.col("price").alias("sold_price"), F.col("day").alias("sold_date")),
    }
    return mappers.map_sources(raws).select("source", "source_item_id", "sold_price", F.col("sold_date").cast("string").alias("sold_date"), "set_name")


_RAW_TITLE = _case("o_orderkey", ["1990 Card", "", "Lot of cards", "Sealed box break", "2001 #7"])
_RAW_PRICE = "CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN '$1,234.50' WHEN 2 THEN 'US $12' WHEN 3 THEN '-3' WHEN 4 THEN '12 to 15' ELSE 'USD 7.25' END"
_RAW_DAY = "CASE o_orderkey % 7 WHEN 0 THEN 'soon' WHEN 1 THEN '2024-02-30' WHEN 2 THEN '2024-03-01 10:00:00 PST' WHEN 3 THEN 'Mar 1, 2024' WHEN 4 THEN '3/1/2024' WHEN 5 THEN '2024-03-01T10:00:00Z' END"
_RAW_URL = "CASE o_orderkey % 8 WHEN 0 THEN 'not an address' WHEN 1 THEN 'https://H.example/A/?q=1#f' ELSE 'https://h.example/i/' || o_orderkey || '/' END"


@query(rf"""
WITH r AS (SELECT o_orderkey, {_RAW_TITLE} AS title, trim(replace(replace(regexp_replace({_RAW_PRICE}, '\bUSD\b|US\s*\$', '', 'g'), '$', ''), ',', '')) AS p, {_RAW_DAY} AS d, {_RAW_URL} AS u FROM orders),
c AS (SELECT *, try_cast(p AS DECIMAL(18,2)) AS price, CASE WHEN d IN ('2024-03-01 10:00:00 PST', 'Mar 1, 2024', '3/1/2024', '2024-03-01T10:00:00Z') THEN DATE '2024-03-01' END AS day,
  CASE WHEN o_orderkey % 9 = 0 THEN 'api' || o_orderkey ELSE nullif(regexp_replace(regexp_extract(u, '^([a-z]+://[^/?#]+[^?#]*)', 1), '/+$', ''), '') END AS item, ' ' || regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g') || ' ' AS t FROM r)
SELECT o_orderkey, price::DOUBLE AS sold_price, day::VARCHAR AS sold_date, item AS source_item_id, array_to_string(list_filter([CASE WHEN title = '' THEN 'missing_title' END, CASE WHEN price IS NULL THEN 'missing_price' END, CASE WHEN price <= 0 THEN 'nonpositive_price' END,
  CASE WHEN day IS NULL THEN 'missing_sold_date' END, CASE WHEN item IS NULL THEN 'missing_source_item_id' END, CASE WHEN contains(t, ' lot ') THEN 'title_flag:lot' END, CASE WHEN contains(t, ' box ') THEN 'title_flag:box' END,
  CASE WHEN contains(t, ' sealed ') THEN 'title_flag:sealed' END, CASE WHEN contains(t, ' break ') THEN 'title_flag:break' END], lambda x: x IS NOT NULL), ',') AS rejects FROM c
""")
def built_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    raw = table(spark, d, "orders").select("o_orderkey", _spark(_RAW_TITLE).alias("title"), _spark(_RAW_PRICE).alias("sold_price"), _spark(_RAW_DAY).alias("sold_date"), _spark(_RAW_URL).alias("url"), F.when(k % 9 == 0, F.concat(F.lit("api"), k)).otherwise("").alias("api_id"), k.cast("string").alias("src_row"))
    out = mappers.build_rows(raw, "s")
    return out.select(F.col("bridge.source_line").cast("long").alias("o_orderkey"), F.col("sold_price").cast("double").alias("sold_price"), F.col("sold_date").cast("string").alias("sold_date"), "source_item_id", F.array_join("rejects", ",").alias("rejects"))


@query("""
WITH a AS (SELECT o_custkey AS k, o_orderdate::DATE AS day, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price, o_orderkey AS n, 0 AS part FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_custkey, o_orderdate::DATE, o_totalprice, o_orderkey, 1 FROM orders WHERE o_orderkey % 3 = 0)
SELECT k, day::VARCHAR AS day, price, n FROM (SELECT *, row_number() OVER (PARTITION BY k, day ORDER BY price IS NULL, part, n) AS rn FROM a) WHERE rn = 1
""")
def priority_union(spark: SparkSession, d: str) -> DataFrame:
    """A staged and a legacy copy of one source, the staged one first where both have a price."""
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").alias("price"), k.alias("src_row"))
    staged = o.filter("src_row % 2 = 0").withColumn("price", F.when(F.col("src_row") % 4 != 0, F.col("price")))
    out = mappers.by_priority([staged, o.filter("src_row % 3 = 0")], ["k", "day"], [F.col("price").isNull()])
    return out.select("k", F.col("day").cast("string").alias("day"), "price", F.col("src_row").alias("n"))


@query("""
SELECT 'SCP:' || o_orderkey AS observation_id, o_totalprice AS price, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey::VARCHAR END AS ebay_item_id, CASE WHEN o_orderkey % 4 = 0 THEN CASE WHEN o_orderkey % 8 = 0 THEN 'PSA' ELSE 'UNKNOWN' END END AS grade_company,
  CASE WHEN o_orderkey % 4 = 0 THEN 'graded' ELSE 'raw_or_unknown' END AS raw_or_graded, o_orderkey % 5 = 0 AS best_offer FROM orders
""")
def nested_archive(spark: SparkSession, d: str) -> DataFrame:
    """Orders as lines of the nested archive and back."""
    k = F.col("o_orderkey")
    raw = F.struct(F.when(k % 3 == 0, F.concat(F.lit("x ebay-"), F.col("o_custkey"), F.lit(" y"))).otherwise("none").alias("ledger_anchor"), F.when(k % 4 == 0, "10").otherwise("").alias("grade_label"), F.when(k % 5 == 0, "True").otherwise("false").alias("best_offer"))
    line = F.to_json(F.struct(k.cast("string").alias("source_item_id"), F.when(k % 8 == 0, "Card PSA 10").otherwise("Card").alias("title"), F.format_string("$%,.2f", F.col("o_totalprice")).alias("sold_price"), raw.alias("raw")))
    rows = table(spark, d, "orders").select(F.from_json(line, mappers.NESTED).alias("r")).select("r.*").withColumns({"src_file": F.lit("f"), "src_row": F.lit(0)})
    out = canonical.normalize(rows, mappers.nested_spec())
    return out.select("observation_id", F.col("sold_price_usd").alias("price"), "ebay_item_id", "grade_company", "raw_or_graded", "best_offer")


_ITEM = "CASE o_orderkey % 3 WHEN 0 THEN 'https://h/bidplace.aspx?itemid=' || o_orderkey WHEN 1 THEN 'https://h/x?a=1&itemid=' || o_orderkey || '&b=2' ELSE 'plain-' || o_orderkey END"


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 <> 2 THEN regexp_extract({_ITEM}, '[?&]itemid=([0-9]+)', 1) ELSE {_ITEM} END AS sale_key, round((o_totalprice::DECIMAL(28,6) + CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 4.99 END), 2)::DOUBLE AS paid FROM orders")
def sale_keys_and_totals(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    venue = F.when(k % 2 == 0, "lelands").otherwise("goldin")
    paid = scalars.with_shipping(F.col("o_totalprice"), F.when(k % 4 != 0, 4.99))
    return table(spark, d, "orders").select("o_orderkey", mappers.sale_key(venue, _spark(_ITEM)).alias("sale_key"), paid.cast("double").alias("paid"))


# --- sales ------------------------------------------------------------------------------------------------------------
@query("""
WITH s AS (SELECT o_orderkey AS k, o_totalprice AS p, o_orderdate::DATE AS d, o_orderkey % 5 = 0 AS m, 'sale ' || lower(o_orderpriority) || ' ' || lower(o_orderstatus) || 'status' AS t, CASE WHEN o_orderkey % 3 = 0 THEN [(o_custkey % 20)::VARCHAR] ELSE [] END AS ps FROM orders),
w AS (SELECT *, list_distinct(list_filter(regexp_extract_all(t, '[a-z][a-z.''-]*'), lambda x: len(x) > 2)) AS ws FROM s)
SELECT a.k AS a, b.k AS b FROM w a JOIN w b ON a.k < b.k AND abs(a.p - b.p) <= 0.01 * greatest(a.p, b.p) AND CASE WHEN a.m OR b.m THEN strftime(a.d, '%Y-%m') = strftime(b.d, '%Y-%m') ELSE abs(date_diff('day', a.d, b.d)) <= 3 END
WHERE a.p > 0 AND b.p > 0 AND CASE WHEN len(a.ps) > 0 AND len(b.ps) > 0 THEN list_has_any(a.ps, b.ps) ELSE len(list_intersect(a.ws, b.ws)) / len(list_distinct(a.ws || b.ws)) >= 0.3 END
""")
def same_sale_pairs(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select(
        k.alias("k"), F.col("o_totalprice").alias("p"), F.col("o_orderdate").alias("d"), (k % 5 == 0).alias("m"), F.concat(F.lit("sale "), F.lower("o_orderpriority"), F.lit(" "), F.lower("o_orderstatus"), F.lit("status")).alias("t"),
        F.when(k % 3 == 0, F.array((F.col("o_custkey") % 20).cast("string"))).otherwise(F.array().cast("array<string>")).alias("ps"),
    )
    return sales.same_sales(o, "k", "p", "d", "m", "t", "ps")


@query("""
WITH n AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0), h AS (SELECT * FROM orders WHERE o_orderkey % 2 = 1)
SELECT o_orderkey, EXISTS (SELECT 1 FROM h WHERE h.o_orderpriority = n.o_orderpriority AND h.o_orderstatus = n.o_orderstatus AND abs(date_diff('day', h.o_orderdate::DATE, n.o_orderdate::DATE)) <= 3 AND abs(h.o_totalprice - n.o_totalprice) <= 0.02 * n.o_totalprice) AS present FROM n
""")
def already_loaded(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return sales.already_there(o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 = 1"), ["o_orderpriority", "o_orderstatus"], "o_totalprice", "o_orderdate").select("o_orderkey", "present")


SAID = ["Topps Chrome Gold Refractor", "Chrome", "Topps Finest", "Chrome Refractors auto", "chrome blue jays", "Chrome Gold /50", "Chrome Gold Refractor /25", "Complete Set Chrome", "Bowman Chrome Gold Refractors", "chrome signed RC"]
_SAID = "'2020 ' || " + _case("p_partkey", SAID)
_LIST = lambda words: "[" + ", ".join(f"'{w}'" for w in sorted(words)) + "]"
_WORDS = "list_distinct(list_transform(list_filter(regexp_extract_all(lower({}), '[a-z0-9]+'), lambda x: NOT regexp_full_match(x, '[0-9]+')), lambda x: coalesce(map_extract_value(map {{" + ", ".join(f"'{a}': '{b}'" for a, b in cards.SYNONYMS.items()) + "}}, x), x)))"
_MINUS = "list_filter({}, lambda x: NOT list_contains({}, x))"


@query(rf"""
WITH t AS (SELECT p_partkey, {_SAID} AS title, CASE WHEN p_partkey % 3 = 0 THEN 'Gold Refractor' ELSE '' END AS parallel, CASE WHEN p_partkey % 3 = 0 THEN 50 END AS card_run, CASE WHEN p_partkey % 7 = 0 THEN 2019 ELSE 2020 END AS card_year FROM part),
w AS (SELECT *, regexp_replace(lower(title), '\b(blue jays|red sox)\b', ' ', 'g') AS plain, try_cast(nullif(regexp_extract(title, '/([0-9]+)', 1), '') AS INTEGER) AS run FROM t),
x AS (SELECT *, {_WORDS.format("plain")} AS said, {_WORDS.format("'2020 Topps Chrome Baseball'")} AS s0, {_WORDS.format("parallel")} AS pw FROM w),
y AS (SELECT *, {_MINUS.format("s0", _LIST(cards.SET_STOP))} AS sw FROM x),
z AS (SELECT *, {_MINUS.format(_MINUS.format("sw", _LIST(cards.BRANDS)), "said")} AS lacking, {_MINUS.format(f"list_intersect({_LIST(cards.PRODUCTS)}, said)", "(sw || pw)")} AS lines, {_MINUS.format("pw", "said")} AS unnamed,
  {_MINUS.format(f"list_intersect({_LIST(cards.PARALLELS)}, said)", "(sw || pw)")} AS others FROM y)
SELECT p_partkey, CASE WHEN contains(plain, 'complete set') THEN 'not a single card (set, lot or sealed product)' WHEN card_year <> 2020 THEN 'year 2020 vs catalog ' || card_year
  WHEN len(lacking) > 0 THEN 'set words not in the title: ' || array_to_string(list_sort(lacking), ' ') WHEN len(lines) > 0 THEN 'title names another product line: ' || array_to_string(list_sort(lines), ' ')
  WHEN list_has_any(said, ['auto', 'signed']) THEN 'signed copy of a card with no autograph version (after-market signature)' WHEN len(unnamed) > 0 THEN 'catalog parallel not in the title: ' || array_to_string(list_sort(unnamed), ' ')
  WHEN len(others) > 0 THEN 'title names a parallel the card lacks: ' || array_to_string(list_sort(others), ' ') WHEN run <> card_run THEN 'print run /' || run || ' vs /' || card_run END AS why FROM z
""")
def card_mismatches(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    t = table(spark, d, "part").select("p_partkey", _spark(_SAID).alias("title"))
    why = cards.mismatch(
        F.col("title"), F.lit("2020 Topps Chrome Baseball"), F.when(k % 3 == 0, "Gold Refractor").otherwise(""), cards.print_run(F.col("title")), F.when(k % 3 == 0, 50), F.lit(2020), F.when(k % 7 == 0, 2019).otherwise(2020)
    )
    return t.select("p_partkey", why.alias("why"))


@query("""
WITH s AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS sale_id, l_partkey || CASE WHEN l_linenumber % 2 = 0 THEN '~gold' ELSE '' END AS card_id, l_returnflag AS grade, l_extendedprice AS price FROM lineitem),
e AS (SELECT s.sale_id, s.price, max(o.price) FILTER (o.card_id = s.card_id AND o.grade = s.grade) AS p0, max(o.price) FILTER (o.card_id = s.card_id) AS p1, max(o.price) AS p2 FROM s LEFT JOIN s o ON split_part(o.card_id, '~', 1) = split_part(s.card_id, '~', 1) AND o.sale_id <> s.sale_id GROUP BY ALL)
SELECT sale_id, CASE WHEN p0 IS NOT NULL THEN 0 WHEN p1 IS NOT NULL THEN 1 WHEN p2 IS NOT NULL THEN 2 END AS level, coalesce(coalesce(p0, p1, p2) >= price / 2, false) AS backed FROM e
""")
def backed_prices(spark: SparkSession, d: str) -> DataFrame:
    card = F.concat("l_partkey", F.when(F.col("l_linenumber") % 2 == 0, "~gold").otherwise(""))
    s = table(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("sale_id"), card.alias("card_id"), F.col("l_returnflag").alias("grade"), F.col("l_extendedprice").alias("price"), F.lit("house").alias("venue"))
    return sales.backed(s, s, 2.0).select("sale_id", "level", "backed")


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey % 50 AS card, l_returnflag AS grade, l_extendedprice AS p FROM lineitem), g AS (SELECT card, grade, count(*) AS n, median(p) AS mid FROM s GROUP BY ALL), r AS (SELECT card, median(p) AS raw FROM s WHERE grade = 'N' GROUP BY ALL)
SELECT l_orderkey, l_linenumber, CASE WHEN n >= 5 AND (p > 2 * mid OR p < mid / 2) THEN 'outlier' WHEN n < 5 AND grade <> 'N' AND p > 3 * raw THEN 'thin_graded' ELSE 'guaranteed' END AS trust FROM s JOIN g USING (card, grade) LEFT JOIN r USING (card)
""")
def fenced_sales(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 50).alias("card"), F.col("l_returnflag").alias("grade"), F.col("l_extendedprice").alias("p"))
    return sales.fenced(s, ["card", "grade"], F.col("grade") == "N", "p", ["card"], 2.0, 5, 3.0).select("l_orderkey", "l_linenumber", "trust")


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice >= 50000 AND o_orderstatus <> 'P' THEN CASE WHEN o_orderkey % 13 = 0 THEN 'press_only' WHEN o_orderkey % 11 = 0 THEN 'asking_price' WHEN o_totalprice >= 300000 AND o_orderkey % 2 = 0 THEN 'not_approved' WHEN o_orderkey % 7 = 0 THEN 'month_precision'
  WHEN o_orderkey % 5 = 1 THEN 'own_label_slab' WHEN o_orderpriority = '1-URGENT' THEN 'unpaid' WHEN o_orderkey % 17 = 0 THEN 'no_grade' ELSE 'loaded' END END AS state,
  CASE WHEN o_orderkey % 3 = 0 THEN 'best_offer' WHEN o_orderkey % 4 = 0 THEN 'unverified_basis' ELSE 'trusted' END AS trust FROM orders
""")
def held_headline_sales(spark: SparkSession, d: str) -> DataFrame:
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    title = F.when(k % 5 == 1, "Card BLACK LABEL 10").when(k % 5 == 2, "Topps Gold Label card").otherwise("Card")
    state = sales.held_reason(
        F.when(price >= 300000, "resolved_needs_review").otherwise("resolved"), price, F.when(F.col("o_orderstatus") == "P", "elsewhere").otherwise("goldin"), F.when(k % 11 == 0, "https://h/buy-now/1"), k % 7 == 0, title,
        F.when(F.col("o_orderpriority") == "1-URGENT", "Unpaid"), F.when(k % 17 != 0, "PSA 10"), k % 2 == 1, k % 13 != 0, ["goldin"], 50000,
    )
    return table(spark, d, "orders").select("o_orderkey", state.alias("state"), sales.price_trust(k % 3 == 0, k % 4 != 0).alias("trust"))


_AUCTIONS = "SELECT o_orderkey AS auction_id, CASE WHEN o_orderstatus = 'F' THEN 'Completed' ELSE 'Open' END AS status, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS end_timestamp FROM orders"


@query(f"""
WITH a AS ({_AUCTIONS}), c AS (SELECT * FROM a WHERE status = 'Completed' AND auction_id % 3 <> 0)
SELECT 'newest' AS part, auction_id FROM (SELECT auction_id FROM c ORDER BY end_timestamp DESC, auction_id LIMIT 10) UNION ALL SELECT 'window', auction_id FROM c WHERE end_timestamp >= '1994-01-01' AND end_timestamp < '1994-07-01'
""")
def auctions_to_read(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    a = o.select(F.col("o_orderkey").alias("auction_id"), F.when(F.col("o_orderstatus") == "F", "Completed").otherwise("Open").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("end_timestamp"))
    done = a.filter("auction_id % 3 = 0").select("auction_id")
    name = lambda df, part: df.select(F.lit(part).alias("part"), "auction_id")
    return name(sales.newest_completed(a, done, 10), "newest").unionByName(name(sales.completed_between(a, done, "1994-01-01", "1994-07-01"), "window"))


@query("""
SELECT o_orderkey, CASE WHEN d >= DATE '1995-01-01' AND d < DATE '1999-01-01' AND NOT (d >= DATE '1996-06-01' AND d < DATE '1997-06-01') THEN 'main' WHEN d >= DATE '1996-06-01' AND d < DATE '1996-09-01' THEN 'band' END AS part FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)
WHERE (d >= DATE '1995-01-01' AND d < DATE '1999-01-01' AND NOT (d >= DATE '1996-06-01' AND d < DATE '1997-06-01')) OR (d >= DATE '1996-06-01' AND d < DATE '1996-09-01')
""")
def window_with_side_band(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return sales.window_with_band(o, "o_orderdate", "1995-01-01", "1999-01-01", ("1996-06-01", "1997-06-01"), ("1996-06-01", "1996-09-01")).select("o_orderkey", "part")


@query("""
WITH p AS (SELECT (date_diff('day', o_orderdate::DATE, DATE '1998-08-05') // 5) AS page, o_orderdate::DATE AS d FROM orders), g AS (SELECT page, count(*) FILTER (d = DATE '1998-06-01') AS n, max(d) < DATE '1998-06-01' AS old FROM p GROUP BY page)
SELECT page, n, page <= coalesce((SELECT min(page) FROM g WHERE old), page) AS keep FROM g
""")
def pages_until_older(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    o = table(spark, d, "orders").select(day.alias("d"), F.expr("datediff(DATE '1998-08-05', CAST(o_orderdate AS DATE)) DIV 5").alias("page"))
    return sales.pages_to_read(o, "d", "page", F.lit("1998-06-01").cast("date"))


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 3 END, o_totalprice DESC, o_orderkey) AS nth, coalesce(try_cast(nullif(replace(o_orderpriority, '-', ''), '') AS BIGINT), 1000000) AS roster FROM orders")
def believed_first(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    order = sales.belief_order(F.replace(F.replace("o_orderstatus", F.lit("F"), F.lit("fanatics_api")), F.lit("O"), F.lit("neon")), F.col("o_totalprice"))
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy(*order, "o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey", nth.alias("nth"), sales.roster_order(F.replace("o_orderpriority", F.lit("-"), F.lit(""))).alias("roster"))


# --- audits and runs --------------------------------------------------------------------------------------------------
@query("""
WITH r AS (SELECT CASE WHEN l_orderkey % 9 <> 0 THEN l_partkey END AS id, CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 0 ELSE l_extendedprice END AS p, l_returnflag FROM lineitem)
SELECT count(*) AS rows, count(DISTINCT id) AS unique_ids, count(id) - count(DISTINCT id) AS intra_dupes, count(*) FILTER (id IS NULL) AS no_id, count(*) FILTER (p > 0) AS price_ok, count(*) FILTER (p <= 0) AS price_zero, count(*) FILTER (p IS NULL) AS price_missing,
  coalesce(sum(p::DECIMAL(28,6)) FILTER (p > 0), 0)::DOUBLE AS price_sum, count(*) FILTER (l_returnflag = 'R') AS best_offer_true FROM r
""")
def store_counts(spark: SparkSession, d: str) -> DataFrame:
    price = F.when(F.col("l_linenumber") == 2, 0.0).when(F.col("l_linenumber") != 1, F.col("l_extendedprice"))
    r = table(spark, d, "lineitem").select(F.when(F.col("l_orderkey") % 9 != 0, F.col("l_partkey")).alias("id"), price.alias("p"), "l_returnflag")
    return monitor.store_audit(r, "id", F.col("p"), {"best_offer_true": F.col("l_returnflag") == "R"})


_PRICE_BANDS, _PRICE_NAMES = [1, 10, 50, 100, 500, 1000, 5000, 50000], ["<1", "1-10", "10-50", "50-100", "100-500", "500-1k", "1k-5k", "5k-50k", ">=50k"]


@query(f"""
SELECT 'price' AS name, CASE {" ".join(f"WHEN o_totalprice < {e} THEN '{n}'" for e, n in zip(_PRICE_BANDS, _PRICE_NAMES, strict=False))} ELSE '>=50k' END AS bucket, count(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'sold_month', strftime(o_orderdate, '%Y-%m'), count(*) FROM orders GROUP BY ALL UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders GROUP BY ALL
UNION ALL SELECT 'release', CASE WHEN year(o_orderdate) >= 1997 THEN 'new' WHEN year(o_orderdate) >= 1994 THEN 'recent' ELSE 'old' END, count(*) FROM orders GROUP BY ALL
""")
def store_histograms(spark: SparkSession, d: str) -> DataFrame:
    year = F.year("o_orderdate")
    buckets = {
        "price": rules.bands(F.col("o_totalprice"), _PRICE_BANDS, _PRICE_NAMES), "sold_month": scalars.month_of(F.col("o_orderdate")), "status": F.col("o_orderstatus"),
        "release": F.when(year >= 1997, "new").when(year >= 1994, "recent").otherwise("old"),
    }
    return monitor.histograms(table(spark, d, "orders"), buckets)


@query("SELECT c_mktsegment, count(*) AS n, count(DISTINCT c_nationkey) AS n_c_nationkey FROM customer GROUP BY ALL")
def distinct_totals(spark: SparkSession, d: str) -> DataFrame:
    return monitor.totals(table(spark, d, "customer"), ["c_mktsegment"], ["c_nationkey"])


@query("""
WITH b AS (SELECT source, count(*) AS n, count(*) FILTER (doc_id % 8 <> 0) AS m FROM documents GROUP BY source)
SELECT sum(n)::BIGINT AS n_before, sum(m)::BIGINT AS n_after, coalesce(string_agg(source, ',' ORDER BY source) FILTER (n >= 50 AND m < n * 0.9::DOUBLE), '') AS groups, count(*) FILTER (n >= 50 AND m < n * 0.9::DOUBLE) > 0 OR sum(m) < sum(n) * 0.9::DOUBLE AS refuse FROM b
""")
def shrink_total(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source")
    return monitor.shrink_verdict(docs, docs.filter("doc_id % 8 <> 0"), "source", 50).withColumn("groups", F.array_join("groups", ","))


@query("""
SELECT event_type, count(*) FILTER (value > 80) AS n_bad, count(*) FILTER (value <= 80) AS n_good, CASE WHEN count(value) > 0 THEN round(count(*) FILTER (value > 80) / count(value)::DOUBLE, 9) END AS rate, median(value) AS median FROM events GROUP BY event_type
""")
def block_rates(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    r = monitor.rate(e, ["event_type"], F.col("value") > 80, F.col("value") <= 80).withColumn("rate", F.round("rate", 9))
    return r.join(monitor.yields(e, ["event_type"], "value").select("event_type", "median"), "event_type")


@query("""
WITH c AS (SELECT l_partkey, max(n) AS top FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_partkey), t AS (SELECT CASE WHEN top >= 4 THEN 'daily' WHEN top >= 2 THEN 'weekly' ELSE 'monthly' END AS tier FROM c)
SELECT tier, count(*) AS n, count(*) / CASE tier WHEN 'daily' THEN 1.0::DOUBLE WHEN 'weekly' THEN 7.0::DOUBLE ELSE 30.0::DOUBLE END AS per_day FROM t GROUP BY tier
""")
def tier_loads(spark: SparkSession, d: str) -> DataFrame:
    tiers = monitor.activity_tiers(table(spark, d, "lineitem"), "l_partkey", "l_suppkey", [(4, "daily"), (2, "weekly")], "monthly")
    return monitor.tier_load(tiers, "tier", {"daily": 1, "weekly": 7, "monthly": 30})


@query("""
WITH p AS (SELECT c_mktsegment, CASE WHEN c_mktsegment <> 'BUILDING' THEN TIMESTAMP '1996-01-01' END AS began, c_custkey FROM customer), s AS (SELECT o_custkey, max(o_orderdate) AS seen FROM orders GROUP BY o_custkey),
g AS (SELECT c_mktsegment, count(*) AS n_items, count(*) FILTER (seen >= began) AS n_done, any_value(began) AS began FROM p LEFT JOIN s ON c_custkey = o_custkey GROUP BY c_mktsegment)
SELECT c_mktsegment, n_items, n_done, CASE WHEN began IS NULL THEN 'new_pass' WHEN n_done >= n_items AND date_diff('hour', began, TIMESTAMP '1996-03-01') > 960 THEN 'new_pass' WHEN date_diff('hour', began, TIMESTAMP '1996-03-01') > 1440 THEN 'new_pass' WHEN n_done >= n_items THEN 'complete' ELSE 'reading' END AS state FROM g
""")
def ring_passes(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_mktsegment", "c_custkey")
    log = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("timestamp").alias("at"))
    passes = c.filter("c_mktsegment <> 'BUILDING'").select("c_mktsegment").distinct().withColumn("began", F.lit("1996-01-01").cast("timestamp"))
    return states.pass_due(c, log, passes, "c_mktsegment", "c_custkey", "at", F.lit("1996-03-01").cast("timestamp"), 960).drop("began")


@query("""
WITH l AS (SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN 'planned' WHEN 'view' THEN 'running' WHEN 'click' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'paused' END AS status FROM events), p AS (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY event_id) AS from_status FROM l)
SELECT user_id, event_id, from_status, status FROM p WHERE NOT CASE WHEN from_status IS NULL THEN status IN ('planned', 'running') WHEN from_status = 'planned' THEN status = 'running' WHEN from_status = 'running' THEN status IN ('completed', 'failed', 'paused') WHEN from_status = 'failed' THEN status = 'running'
  WHEN from_status = 'paused' THEN status = 'running' ELSE false END
""")
def bad_run_steps(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("event_type")
    status = F.when(t == "signup", "planned").when(t == "view", "running").when(t == "click", "completed").when(t == "error", "failed").otherwise("paused")
    return states.bad_steps(table(spark, d, "events").select("user_id", "event_id", status.alias("status")), ["user_id"], ["event_id"])


@query("""
WITH a AS (SELECT p_brand, count(*) AS n FROM part GROUP BY ALL), b AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL), c AS (SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY ALL)
SELECT 0 AS level, p_brand AS path, n, false AS open FROM a WHERE n <= 80 UNION ALL SELECT 1, p_brand || '/' || p_type, b.n, false FROM b JOIN a USING (p_brand) WHERE a.n > 80 AND b.n <= 12
UNION ALL SELECT 2, p_brand || '/' || p_type || '/' || p_size, c.n, c.n > 12 FROM c JOIN b USING (p_brand, p_type) JOIN a USING (p_brand) WHERE a.n > 80 AND b.n > 12
""")
def split_by_levels(spark: SparkSession, d: str) -> DataFrame:
    """Parts of 80 at the first level and of 12 below it."""
    p = table(spark, d, "part").select("p_brand", "p_type", "p_size")
    first = sharding.split_levels(p, ["p_brand"], 80)
    deeper = p.join(first.filter("open").select(F.col("path")[0].alias("b")), F.col("p_brand") == F.col("b"), "left_semi")
    below = sharding.split_levels(deeper, ["p_brand", "p_type", "p_size"], 12).filter("level > 0")
    out = first.filter("NOT open").unionByName(below)
    return out.withColumn("path", F.array_join("path", "/"))


@query("SELECT count(*) FILTER (p_retailprice < 950) AS n_below, count(*) FILTER (p_retailprice >= 950 + 256) AS n_above, count(*) FILTER (p_retailprice IS NULL) AS n_missing FROM part")
def rows_outside_shards(spark: SparkSession, d: str) -> DataFrame:
    return sharding.outside(table(spark, d, "part"), "p_retailprice", 950, 1200)


@query("""
WITH seen AS (SELECT event_id FROM events WHERE event_id % 5 = 0)
SELECT event_id FROM events WHERE event_id NOT IN (SELECT event_id FROM seen) AND (event_id % 7 = 0 OR ts > TIMESTAMP '2024-01-10')
""")
def unseen_feed_items(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("ts").cast("timestamp_ntz")).alias("at"))
    return incremental.unseen_items(e, "event_id", "at", F.lit("2024-01-10").cast("timestamp_ntz"), e.filter("event_id % 5 = 0")).select("event_id")


# --- published catalogs -----------------------------------------------------------------------------------------------
_HEAD = "(1950 + o_orderkey % 90) || ' ' || " + _case("o_orderkey", ["Topps Ann Lee #7 PSA 10", "T206 Piedmont 150/25 SGC EX 5", "Prizm #BD-50 12/25 BGS GEM MINT 9.5", "Finest #78 /99", "Goudey no number", "Fleer # 12 psa"])


@query(rf"""
WITH t AS (SELECT o_orderkey, {_HEAD} AS t FROM orders), b AS (SELECT *, regexp_replace(t, 'Piedmont 150/25', ' ') AS f FROM t)
SELECT o_orderkey, try_cast(nullif(regexp_extract(t, '\b(19[0-9]{{2}}|20[0-4][0-9])\b', 1), '') AS INTEGER) AS year, nullif(regexp_extract(t, '#\s*([A-Za-z0-9]+(?:-[A-Za-z0-9]+)*)', 1), '') AS code,
  nullif(regexp_extract(f, ' ([0-9]+/[0-9]+)\b', 1), '') AS serial, try_cast(nullif(regexp_extract(f, '/([0-9]+)\b', 1), '') AS INTEGER) AS print_run,
  CASE WHEN regexp_matches(t, '(PSA|SGC|BGS) .*[0-9]') THEN regexp_extract(t, '(PSA|SGC|BGS)', 1) || ' ' || regexp_extract(t, '(?:PSA|SGC|BGS) [A-Za-z ]*([0-9.]+)', 1) END AS grade FROM b
""")
def headline_titles(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "orders").select("o_orderkey", linking.parse_headline(_spark(_HEAD)).alias("p"))
    return t.select("o_orderkey", "p.year", "p.code", "p.serial", "p.print_run", "p.grade")


_ADDRESS = "CASE p_partkey % 5 WHEN 0 THEN 'baseball' WHEN 1 THEN 'hockey' WHEN 2 THEN 'ufc' WHEN 3 THEN 'chess' ELSE 'golf' END || CASE WHEN p_partkey % 7 = 0 THEN '-set-' ELSE '-cards-' END || '2020-x' || (p_partkey % 9) || '/ann-' || p_partkey"


@query(f"""
WITH s AS (SELECT p_partkey, {_ADDRESS} AS s FROM part), h AS (SELECT p_partkey, split_part(s, '/', 1) AS h FROM s)
SELECT p_partkey, CASE WHEN contains(h, '-cards-') THEN 'scp:' || CASE split_part(h, '-cards-', 1) WHEN 'baseball' THEN 'bb' WHEN 'hockey' THEN 'hk' WHEN 'ufc' THEN 'ufc' WHEN 'golf' THEN 'gf' END || ':' || split_part(h, '-cards-', 2) END AS set_id FROM h
""")
def set_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", ledger.set_id(_spark(_ADDRESS)).alias("set_id"))


@query("""
SELECT o_orderkey FROM orders WHERE o_totalprice >= 100000 AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderstatus IN ('F', 'O') AND NOT coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 2 = 0 END, false)
  AND coalesce(CASE WHEN o_orderkey % 5 = 0 THEN 'https://h/buy-now/' || o_orderkey END, CASE WHEN o_orderkey % 7 = 0 THEN 'https://h/buy-now/x' END, '') NOT LIKE '%/buy-now/%'
""")
def collected_sales(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        k, F.col("o_totalprice").alias("sold_price"), F.col("o_orderdate").cast("date").alias("sold_date"), F.col("o_orderstatus").alias("source_code"), F.when(k % 3 == 0, k % 2 == 0).alias("best_offer"),
        F.when(k % 5 == 0, F.concat(F.lit("https://h/buy-now/"), k)).alias("canonical_source_url"), F.when(k % 7 == 0, "https://h/buy-now/x").alias("source_url"),
    )
    return ledger.collect_sales(rows, ["F", "O"], 100000, "1995-01-01").select("o_orderkey")


@query("""
WITH n AS (SELECT o_orderstatus, o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS rn FROM orders)
SELECT o_orderstatus, o_orderpriority, count(*) AS n, string_agg(o_orderkey, ',' ORDER BY o_orderkey) FILTER (rn <= 6) AS examples FROM n GROUP BY ALL
""")
def outcome_examples(spark: SparkSession, d: str) -> DataFrame:
    out = ledger.outcomes(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"], "o_orderkey")
    return out.withColumn("examples", F.array_join("examples", ","))


@query("""
WITH w AS (SELECT o_orderkey AS id, o_custkey % 40 AS c FROM orders WHERE o_orderkey % 3 <> 0), h AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN (o_custkey + 1) % 40 ELSE o_custkey % 40 END AS c, o_orderkey % 11 <> 0 AS p FROM orders WHERE o_orderkey % 4 <> 0),
j AS (SELECT coalesce(w.id, h.id) AS id, w.id IS NOT NULL AS wanted, h.id IS NOT NULL AS there, w.c AS n, h.c AS o, p FROM w FULL JOIN h ON w.id = h.id)
SELECT 'insert' AS action, id FROM j WHERE NOT there UNION ALL SELECT 'move', id FROM j WHERE wanted AND there AND n <> o UNION ALL SELECT 'retract', id FROM j WHERE NOT wanted AND p UNION ALL SELECT 'republish', id FROM j WHERE wanted AND there AND NOT p
UNION ALL SELECT 'add', c FROM (SELECT DISTINCT c FROM w) WHERE c NOT IN (SELECT x FROM range(30) t(x)) UNION ALL SELECT 'restore', x FROM range(30) t(x) WHERE x % 4 = 0 AND x % 2 = 0
UNION ALL SELECT 'withdraw', x FROM range(30) t(x) WHERE x % 4 <> 0 AND x % 2 = 1 AND x NOT IN (SELECT c FROM w) UNION ALL SELECT 'number_key', x FROM range(30) t(x) WHERE x % 3 = 0
""")
def published_plan(spark: SparkSession, d: str) -> DataFrame:
    """Orders as sales of forty cards, thirty of them published, every other on the checklist."""
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select(k.cast("string").alias("sale_id"), (F.col("o_custkey") % 40).cast("string").alias("card_id"), k, "o_custkey")
    have = o.filter(k % 4 != 0).select("sale_id", F.when(k % 5 == 0, ((F.col("o_custkey") + 1) % 40).cast("string")).otherwise(F.col("card_id")).alias("card_id"), (k % 11 != 0).alias("published"))
    i = F.col("id")
    cards_ = spark.range(30).select(i.cast("string").alias("card_id"), (i % 4 != 0).alias("visible"), F.concat(F.lit("0"), i).alias("number"), F.when(i % 3 == 0, "x").otherwise(i.cast("string")).alias("number_key"))
    plan = ledger.catalog_plan(cards_, spark.range(0, 30, 2).select(i.cast("string").alias("card_id")), o.filter(k % 3 != 0).select("sale_id", "card_id"), have, scalars.number_key)
    return plan.filter("action <> 'redirect'").select("action", F.col("id").cast("long").alias("id"))
