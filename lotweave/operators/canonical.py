"""Observations to one canonical row per (id, day): winner, counts, provenance lists, conflict flags, gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import staging
from ..functions import rules, scalars

KEYS = ["observation_id", "sold_date"]
#: Titles that belong to a page and not to a listing.
PAGE_TITLES = ["shop on ebay", "see all", "results matching fewer words", "new listing", "sponsored"]


def normalize(raw: DataFrame, spec: Mapping[str, Column]) -> DataFrame:
    """Project a source onto the contract; ``spec`` names every output column."""
    return raw.select(*[c.alias(n) for n, c in spec.items()])


def normalize_sources(raws: Mapping[str, DataFrame], specs: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Every source by its own spec, united by name; columns that a source lacks are null."""
    parts = [normalize(raws[n], specs[n]).withColumn("source", F.lit(n)) for n in specs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def listing_spec() -> dict[str, Column]:
    """The contract of marketplace listings in both raw variants (all columns text)."""
    c = F.col
    item = F.coalesce(scalars.first_filled(c("item_id")), scalars.item_id(c("url")))
    return {
        "observation_id": F.concat(F.lit("EBAY:"), item), "source_item_id": item, "title": c("title"),
        "sold_price_usd": scalars.price(F.coalesce(c("sold_price"), c("price"), c("price_text"))), "best_offer": scalars.flag(c("best_offer")),
        "sold_date": F.coalesce(scalars.sold_date(c("sold_date")), scalars.sold_date(c("sold_date_raw"))), "grade": scalars.first_filled(c("grade")),
        "source_url": c("url"), "image_url": c("image_url"), "query": scalars.first_filled(c("source_query"), c("player_query"), scalars.query_param(c("url"), "_skw")),
        "discovery": F.coalesce(scalars.first_filled(c("source")), F.lit("ebay_v2_priority")), "captured_at": c("scraped_at").try_cast("timestamp_ntz"),
        "src_file": c("src_file"), "src_row": c("src_row"),
    }


def stamp(df: DataFrame, **defaults: str) -> DataFrame:
    """Fill blank provenance columns; what is there stays."""
    return df.withColumns({n: F.coalesce(scalars.first_filled(F.col(n)) if n in df.columns else F.lit(None), F.lit(v)) for n, v in defaults.items()})


def canonicalize(rows: DataFrame, order: Sequence[Column], lists: Mapping[str, str], conflicts: Mapping[str, Column], keys: Sequence[str] = KEYS, at: str = "captured_at") -> DataFrame:
    """One row per key: the winner's columns (least ``order``, which must be total), counts, lists and flags. Null days group together.

    One aggregate over one scan: each task keeps the best row of a key that it has seen, so of a key with many rows few are shuffled, and
    which row wins doesn't depend on reading the source twice alike. A flag says that a value that isn't null differs within the key.
    """
    rest = [c for c in rows.columns if c not in keys]
    sets = [F.sort_array(F.collect_set(c)).alias(f"__l_{n}") for n, c in lists.items()]
    flags = [F.coalesce(F.min(c) != F.max(c), F.lit(False)).alias(f"__c_{n}") for n, c in conflicts.items()]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("__w")
    out = rows.groupBy(*keys).agg(best, F.count(F.lit(1)).alias("__n"), F.min(at).alias("__first"), F.max(at).alias("__last"), *sets, *flags)
    return out.select(
        *[F.col(c) if c in keys else F.col(f"__w.{c}").alias(c) for c in rows.columns], F.col("__n").alias("n_observations"), F.col("__first").alias("first_seen_at"),
        F.col("__last").alias("last_seen_at"), *[F.col(f"__l_{n}").alias(n) for n in lists], *[F.col(f"__c_{n}").alias(n) for n in conflicts],
    )


def observation_key(id_col: str = "observation_id", day: str = "sold_date") -> Column:
    return F.concat_ws(":", F.col(id_col), F.coalesce(F.col(day).cast("string"), F.lit("nodate")))


def valuation_gate(title: Column, price: Column, best_offer: Column) -> Column:
    """not_a_listing, no_price, ambiguous_pick, lot_bundle, obo or ok; the first that holds."""
    low = F.lower(F.trim(title))
    return rules.first_of([
        (low.isin(PAGE_TITLES), "not_a_listing"), (price.isNull() | (price <= 0), "no_price"),
        (low.rlike("(pick|choose|select) (your|from|a) "), "ambiguous_pick"), (low.rlike(rules.any_word(["lot", "lots", "bundle", "bulk", "set of [0-9]+"])), "lot_bundle"),
        (F.coalesce(best_offer, F.lit(False)), "obo"),
    ], "ok")


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; ``order`` should end in something unique. Null keys group together."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__w"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__w.{c}").alias(c) for c in rows.columns])


def new_rows(batch: DataFrame, index: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of ``batch`` whose key isn't in ``index`` (null-safe), first one per key."""
    i = index.select(*[F.col(k).alias(f"__{k}") for k in keys])
    return first_wins(batch.join(i, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_anti"), keys, order)


def insert_ignoring(batch: DataFrame, table: DataFrame, unique: Sequence[Sequence[str]], order: Sequence[Column]) -> DataFrame:
    """Rows that inserting one after another in ``order``, ignoring conflicts on any of several unique keys, would add.

    A row that conflicts isn't inserted, so its other keys stay free. Each round accepts the rows that are first in all of their keys and
    strikes out those that conflict with them; rounds are as many as rows wait for one another. Keys with a null never conflict.
    """
    filled = lambda keys: reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

    def without(rows: DataFrame, others: DataFrame) -> DataFrame:
        for keys in unique:
            o = others.select(*[F.col(k).alias(f"__{k}") for k in keys])
            rows = rows.join(o, [F.col(k) == F.col(f"__{k}") for k in keys], "left_anti")
        return rows

    numbered = batch.withColumn("__order", F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*order, F.monotonically_increasing_id()])]))
    left = staging.staged(without(numbered, table), "insert-left")
    some = reduce(lambda a, b: a | b, map(filled, unique))
    accepted = left.filter(~some)
    left = left.filter(some)
    while True:
        marked, first = left, F.lit(True)
        for i, keys in enumerate(unique):
            heads = left.filter(filled(keys)).groupBy(*[F.col(k).alias(f"__{i}_{k}") for k in keys]).agg(F.min("__order").alias(f"__first_{i}"))
            marked = marked.join(heads, [F.col(k) == F.col(f"__{i}_{k}") for k in keys], "left")
            first = first & (F.col(f"__first_{i}").isNull() | (F.col(f"__first_{i}") == F.col("__order")))
        good = staging.staged(marked.filter(first).select(*left.columns), "insert-accepted")
        accepted = accepted.unionByName(good)
        left = staging.staged(without(left, good), "insert-left")
        if left.isEmpty():
            return accepted.drop("__order")


def insert_counts(batch: DataFrame, table: DataFrame, keys: Sequence[str], valid: Column) -> DataFrame:
    """One row (n_new, n_existing, n_bad) of what an insert would do: rows that aren't valid are bad, repeats of a key in the batch exist already."""
    per_key = batch.groupBy(F.coalesce(valid, F.lit(False)).alias("__v"), *keys).agg(F.count(F.lit(1)).alias("__n"))
    known = table.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct().withColumn("__known", F.lit(True))
    both = per_key.join(known, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left")
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("__n"))), F.lit(0))
    fresh = F.count_if(F.col("__v") & F.col("__known").isNull())
    return both.agg(fresh.alias("n_new"), (total(F.col("__v")) - fresh).alias("n_existing"), total(~F.col("__v")).alias("n_bad"))


def split_valid(batch: DataFrame, checks: Sequence[tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows without a fault, and those with one, each with the names of all its ``faults``, for a table of their own."""
    marked = batch.withColumn("faults", rules.all_reasons([(F.coalesce(c, F.lit(True)), n) for c, n in checks]))
    return marked.filter(F.size("faults") == 0).drop("faults"), marked.filter(F.size("faults") > 0)


def without_seen(rows: DataFrame, row_key: str, keys: Column, seen: DataFrame) -> DataFrame:
    """``rows`` none of whose keys (an array) is in ``seen`` (key)."""
    each = rows.select(F.col(row_key).alias("__r"), F.explode(keys).alias("__k"))
    hit = each.join(seen.select(F.col("key").alias("__s")), F.col("__k") == F.col("__s"), "left_semi").select("__r").distinct()
    return rows.join(hit, F.col(row_key) == F.col("__r"), "left_anti")
