"""Linking titles to catalogs, variants, vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import joins, library, linking, strict
from .registry import query, table


def _catalog(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return table(spark, d, "part").select(F.concat(F.lit("card"), "p_partkey").alias("card_id"), c("p_name").alias("character"), F.array(F.lower(c("p_brand"))).alias("set_words"), (c("p_size") % 50).cast("string").alias("number"), "p_partkey", "p_brand", "p_size")


@query()
def strict_title_links(spark: SparkSession, d: str) -> DataFrame:
    """Titles made from the catalog, some of them broken on purpose, linked back or refused with a reason."""
    cat = _catalog(spark, d)
    k = F.col("p_partkey")
    title = F.concat_ws(" ", "p_brand", "character", F.concat(F.lit("#"), "number"), F.when(k % 9 == 0, "lot").when(k % 11 == 0, "psa 9"))
    rows = cat.select(k.alias("row_id"), F.when(k % 13 == 0, "nothing known").otherwise(title).alias("title"))
    words = cat.withColumn("set_words", F.split(scalars.name_key(F.col("p_brand")), " "))
    return linking.link_titles(rows, words.select("card_id", "character", "set_words", "number"))


@query("""
WITH c AS (SELECT 'card' || p_partkey AS card_id, p_brand, p_size FROM part), r AS (SELECT p_partkey AS row_id, p_brand, p_size FROM part UNION ALL SELECT -1 - p_partkey, p_brand, p_size + 100 FROM part),
m AS (SELECT row_id, count(DISTINCT card_id) AS n, min(card_id) AS card_id FROM r JOIN c USING (p_brand, p_size) GROUP BY row_id)
SELECT r.row_id, CASE WHEN n = 1 THEN card_id END AS card_id, CASE WHEN n IS NULL THEN 'no_match' WHEN n > 1 THEN 'ambiguous' ELSE 'ok' END AS reason FROM r LEFT JOIN m USING (row_id)
""")
def catalog_resolve_all(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_partkey").alias("row_id"), "p_brand", "p_size")
    rows = p.union(p.select(-1 - F.col("row_id"), "p_brand", F.col("p_size") + 100))
    return joins.resolve(rows, _catalog(spark, d).select("card_id", "p_brand", "p_size"), "row_id", ["p_brand", "p_size"], [F.lit(1)])


@query("""
SELECT p_partkey, 'card' || p_partkey || '~' || trim(regexp_replace(lower(v.parallel), '[^a-z0-9]+', '-', 'g'), '-') AS variant_id FROM part JOIN (SELECT DISTINCT p_brand, p_type AS parallel FROM part WHERE p_size <= 2) v USING (p_brand)
""")
def variant_matrix(spark: SparkSession, d: str) -> DataFrame:
    cat = _catalog(spark, d)
    parallels = table(spark, d, "part").filter("p_size <= 2").select("p_brand", F.col("p_type").alias("parallel")).distinct()
    return linking.variant_matrix(cat, parallels, ["p_brand"]).select("p_partkey", "variant_id")


@query("""
WITH v AS (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL), w AS (SELECT *, sum(n) OVER (PARTITION BY p_type) AS t, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_brand) AS rn FROM v)
SELECT p_type, p_brand FROM w WHERE rn = 1 AND n / t >= 0.05
""")
def dominant_brand(spark: SparkSession, d: str) -> DataFrame:
    return linking.dominant(table(spark, d, "part"), "p_type", "p_brand", 0.05).select("p_type", "p_brand")


@query()
def same_sale_groups(spark: SparkSession, d: str) -> DataFrame:
    """Orders of one priority that match by price and day, across months too, grouped in order of key."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    pairs = joins.near_pairs(o, "o_orderkey", "o_totalprice", "o_orderdate", 1.0, 3, ["o_orderpriority"])
    return joins.greedy_groups(o, pairs, "o_orderkey", ["o_orderkey"])


_LINES = strict.LinkRules(sets=[strict.SetRule(f"Brand#{i}", ("brand", str(i))) for i in range(1, 100)], uncatalogued=["promo"])


@query()
def strict_card_links(spark: SparkSession, d: str) -> DataFrame:
    """Titles of all parts, some with parallels, serials or words that are refused, linked to all parts as cards of numbered sets."""
    k = F.col("p_partkey")
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    code = F.concat(F.lit("PT-"), (k % 1000).cast("string"))
    catalog = p.select(k.cast("string").alias("card_id"), F.col("p_brand").alias("set_key"), F.lit("base").alias("section"), code.alias("code"), F.col("p_name").alias("character"))
    lists = p.select(F.col("p_brand").alias("set_key"), F.lit("base").alias("section")).distinct()
    on_list = F.explode(F.array(*[F.struct(F.lit(n).alias("parallel"), F.lit(r).cast("int").alias("run")) for n, r in (("Gold Refractor", 50), ("Refractor", None), ("SuperFractor", 1))]))
    lists = lists.select("*", on_list.alias("p")).select("set_key", "section", "p.parallel", "p.run")
    said = F.when(k % 7 == 0, "gold refractor 3/50").when(k % 7 == 1, "gold /25").when(k % 7 == 2, "psa 9").when(k % 7 == 3, "teal").when(k % 7 == 4, "lot").when(k % 7 == 5, "superfractor").otherwise("")
    rows = p.select(k.alias("row_id"), F.concat_ws(" ", F.regexp_replace("p_brand", "#", " "), "p_name", F.concat(F.lit("#"), code), said).alias("title"))
    return strict.link(rows, catalog, lists, _LINES)


@query()
def library_pages(spark: SparkSession, d: str) -> DataFrame:
    """Titles of all parts assigned to addresses made of all parts."""
    k = F.col("p_partkey")
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    brand = F.concat(F.lit("set-"), F.regexp_extract("p_brand", "([0-9]+)", 1))
    slug = F.concat(F.lit("cards-cards-"), F.lit(2000) + k % 20, F.lit("-"), brand, F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.when(k % 3 == 0, "-gold").otherwise(""), F.lit("-"), F.col("p_size"))
    lib = library.parse_library(p.select(slug.alias("slug")))
    sets = p.select(F.replace(brand, F.lit("-"), F.lit(" ")).alias("name"), brand.alias("set_slug")).distinct()
    title = F.concat_ws(" ", (F.lit(2000) + k % 20).cast("string"), F.replace(brand, F.lit("-"), F.lit(" ")), "p_name", F.when(k % 3 == 0, "gold"), F.concat(F.lit("#"), F.col("p_size")))
    none = spark.createDataFrame([], "prefix string, set_slug string")
    return library.assign(p.select(k.alias("row_id"), title.alias("title")), lib, sets, ["gold"], ["gold"], none, "pokemon", "morgan dollar")
