"""What is published against what is wanted, indexes that are made when missing, and undoing by a before-image."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import staging

#: A library's word for a sport and its short code in set ids.
SPORT_CODES = {
    "baseball": "bb", "football": "fb", "basketball": "bk", "soccer": "sc", "hockey": "hk", "wrestling": "wr", "racing": "rc", "ufc": "ufc", "tennis": "tn",
    "golf": "gf", "boxing": "bx",
}


def set_id(slug: Column, prefix: str = "scp") -> Column:
    """``prefix:sport:set`` of an address ``<sport>-cards-<set>/<card>``; null for sports without a code."""
    head = F.substring_index(slug, "/", 1)
    code = F.try_element_at(F.create_map(*[F.lit(x) for kv in SPORT_CODES.items() for x in kv]), F.split_part(head, F.lit("-cards-"), F.lit(1)))
    return F.when(head.contains("-cards-"), F.concat(F.lit(prefix + ":"), code, F.lit(":"), F.split_part(head, F.lit("-cards-"), F.lit(2))))


def ensure_index(spark: SparkSession, lake: str, path: str, keys: Sequence[str], first: str, rebuild: bool = False) -> DataFrame:
    """The index (keys, earliest ``first``) of a lake at ``path``: read if it is there, else made from the lake; empty without a lake."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if rebuild or not fs.exists(hadoop(f"{path}/_SUCCESS")):
        if not fs.exists(hadoop(lake)):
            raise FileNotFoundError(lake)
        rows = spark.read.option("mergeSchema", True).option("basePath", lake).parquet(lake)
        rows.groupBy(*keys).agg(F.min(first).alias(first)).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def collect_sales(rows: DataFrame, sources: Sequence[str], floor: float, since: str) -> DataFrame:
    """Sales of some sources from a price and a day on that are real sales: no accepted offers and no listings still for sale.

    Plain conditions over plain columns, so Parquet and JDBC scans get them.
    """
    url = F.coalesce("canonical_source_url", "source_url", F.lit(""))
    real = ~F.coalesce("best_offer", F.lit(False)) & ~url.like("%/buy-now/%")
    return rows.filter((F.col("sold_price") >= floor) & (F.col("sold_date") >= F.lit(since).cast("date")) & F.col("source_code").isin(list(sources)) & real)


def catalog_plan(cards: DataFrame, checklist: DataFrame, want: DataFrame, have: DataFrame, number_key) -> DataFrame:
    """(kind, action, id, old, new): everything that brings a published catalog and its sales to what is wanted.

    ``cards`` (card_id, visible, number, number_key) and ``have`` (sale_id, card_id, published) are published; ``checklist`` (card_id) are all cards that
    exist, ``want`` (sale_id, card_id) the sales to be published. Sales: insert, move, retract, republish. Cards: add, restore (on the checklist but hidden),
    withdraw (visible, neither on the checklist nor with a wanted sale), number_key (differs from ``number_key(number)``), and redirect:
    a withdrawn card all of whose moved sales went to one other, and none of whose was retracted.
    """
    w, h = want.select("sale_id", F.col("card_id").alias("new")), have.select(F.col("sale_id").alias("hs"), F.col("card_id").alias("old"), "published")
    j = w.join(h, F.col("sale_id") == F.col("hs"), "full_outer")
    move = F.col("new").isNotNull() & F.col("old").isNotNull() & (F.col("new") != F.col("old"))
    actions = F.array_compact(F.array(
        F.when(F.col("hs").isNull(), "insert"), F.when(move, "move"), F.when(F.col("sale_id").isNull() & F.col("published"), "retract"),
        F.when(F.col("sale_id").isNotNull() & F.col("hs").isNotNull() & ~F.col("published"), "republish"),
    ))
    of_sales = j.select(F.lit("sale").alias("kind"), F.explode(actions).alias("action"), F.coalesce("sale_id", "hs").alias("id"), "old", "new")
    of_sales = staging.staged(of_sales, "plan-sales")

    known = checklist.select(F.col("card_id").alias("ck")).distinct()
    live = want.select(F.col("card_id").alias("lk")).distinct()
    c = cards.join(known, F.col("card_id") == F.col("ck"), "left").join(live, F.col("card_id") == F.col("lk"), "left")
    key = number_key(F.col("number"))
    withdrawn = F.col("visible") & F.col("ck").isNull() & F.col("lk").isNull()
    steps = F.array_compact(F.array(
        F.when(~F.col("visible") & F.col("ck").isNotNull(), F.struct(F.lit("restore").alias("a"), F.lit(None).cast("string").alias("o"), F.lit(None).cast("string").alias("n"))),
        F.when(withdrawn, F.struct(F.lit("withdraw").alias("a"), F.lit(None).cast("string").alias("o"), F.lit(None).cast("string").alias("n"))),
        F.when(F.coalesce("number", F.lit("")).cast("string") != "", F.when(~F.col("number_key").eqNullSafe(key), F.struct(F.lit("number_key").alias("a"), F.col("number_key").alias("o"), key.alias("n")))),
    ))
    of_cards = c.select("card_id", F.explode(steps).alias("s")).select(F.lit("card").alias("kind"), F.col("s.a").alias("action"), F.col("card_id").alias("id"), F.col("s.o").alias("old"), F.col("s.n").alias("new"))
    of_cards = staging.staged(of_cards, "plan-cards")
    nothing = F.lit(None).cast("string")
    add = live.join(cards.select("card_id"), F.col("lk") == F.col("card_id"), "left_anti")
    add = add.select(F.lit("card").alias("kind"), F.lit("add").alias("action"), F.col("lk").alias("id"), nothing.alias("old"), nothing.alias("new"))
    moves = of_sales.filter("action = 'move'").groupBy("old").agg(F.count_distinct("new").alias("n"), F.min("new").alias("to"))
    lost = of_sales.filter("action = 'retract'").select("old").distinct()
    gone = of_cards.filter("action = 'withdraw'").select(F.col("id").alias("wid"))
    redirect = moves.filter("n = 1").join(lost, "old", "left_anti").join(gone, F.col("old") == F.col("wid"))
    redirect = redirect.select(F.lit("card").alias("kind"), F.lit("redirect").alias("action"), F.col("wid").alias("id"), "old", F.col("to").alias("new"))
    return of_sales.unionByName(of_cards).unionByName(add).unionByName(redirect)


def replace_links(cards: DataFrame, catalog: DataFrame, links: DataFrame, minted: str = "minted_id") -> tuple[DataFrame, DataFrame]:
    """(cards, links) after a new run: the catalog's values over the old ones, ids minted once and kept, all links those of the run.

    Cards that left the catalog go unless they have a minted id. Links to cards that are gone go too.
    """
    from .reconcile import upsert

    merged = upsert(cards, catalog, "card_id", [minted])
    here = catalog.select(F.col("card_id").alias("__c")).distinct()
    kept = merged.join(here, F.col("card_id") == F.col("__c"), "left").filter(F.col("__c").isNotNull() | F.col(minted).isNotNull()).drop("__c")
    return kept, links.join(kept.select("card_id"), "card_id", "left_semi")


def before_image(table: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    """The rows that a change will touch, as they are: what :func:`.reconcile.revert` takes."""
    return table.join(touched.select(F.col(key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_semi")


def to_revert(audit: DataFrame, now: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) to be put back: entries of an audit (key, value before, ``after``) whose row still is as the change left it.

    A row that was changed again since isn't touched.
    """
    n = now.select(F.col(key).alias("__k"), F.col(value).alias("__now"))
    j = audit.join(n, F.col(key) == F.col("__k"))
    return j.filter(F.col("__now").eqNullSafe(F.col("after")) & ~F.col(value).eqNullSafe(F.col("after"))).select(key, value)


def best_company_count(rows: DataFrame, item: str, title: Column, companies: Sequence[str] = ("PSA", "BGS", "SGC", "CGC")) -> DataFrame:
    """(item, top_count): sales of an item's busiest grading company, titles without one counting as raw."""
    company = F.coalesce(F.nullif(F.regexp_extract(title, f"({'|'.join(companies)})", 1), F.lit("")), F.lit("raw"))
    per = rows.filter(F.col(item).isNotNull()).groupBy(item, company.alias("__g")).agg(F.count(F.lit(1)).alias("__n"))
    return per.groupBy(item).agg(F.max("__n").alias("top_count"))


def outcomes(rows: DataFrame, by: Sequence[str], example: str, most: int = 6) -> DataFrame:
    """(by, n, examples): how often each outcome came, and the ``most`` smallest examples, the feature being a short report.

    Frequent outcomes are ranked within parts first, so no task sees all of one.
    """
    from pyspark.sql import Window

    keyed = rows.select(*by, F.col(example).alias("__e"), F.pmod(F.xxhash64(example), F.lit(64)).alias("__salt"))
    part = Window.partitionBy(*by, "__salt").orderBy("__e")
    few = keyed.withColumn("__r", F.row_number().over(part)).filter(F.col("__r") <= most)
    few = few.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy("__e"))).filter(F.col("__r") <= most)
    shown = few.groupBy(*by).agg(F.sort_array(F.collect_list("__e")).alias("examples")).withColumnsRenamed({b: f"__{b}" for b in by})
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(shown, [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by], "left").drop(*[f"__{b}" for b in by])


def without_hosts(rows: DataFrame, url: str, dead: Sequence[str], settled: DataFrame | None = None, key: str = "key") -> DataFrame:
    """Pictures worth asking for: not on a dead host, and not settled (``settled`` has the keys whose last status is final)."""
    host = F.lower(F.split_part(F.coalesce(url, F.lit("")), F.lit("/"), F.lit(3)))
    out = rows.filter(~host.isin(list(dead)))
    return out if settled is None else out.join(settled.select(F.col(key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_anti")
