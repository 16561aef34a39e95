"""Tolerance joins, null-safe semi and anti joins, same-sale groups, catalog resolution."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..staging import small_or_merged, staged

#: Groups of catalog rows that are alike but for their id are broadcast up to so many rows.
MAX_BROADCAST_GROUPS = 100_000


def semi_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    r = right.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    return left.join(r, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], how)


def near_pairs(rows: DataFrame, key: str, price: str, day: str, percent: float = 1.0, days: int = 3, equal: Sequence[str] = ()) -> DataFrame:
    """(a, b) with a < b whose prices differ by at most ``percent`` of the larger one and whose days by at most ``days``.

    Logarithmic price buckets are as wide as the tolerance and day buckets as wide as ``days`` + 1, so partners are in the same or the next
    bucket: one side is dealt to neighbours and an equi-join follows; the exact predicate is applied last.
    """
    width = -math.log(1 - percent / 100)
    p, d = F.col(price).cast("double"), F.col(day).cast("date")
    base = rows.filter(p > 0).select(F.col(key).alias("k"), p.alias("p"), d.alias("d"), *equal, F.floor(F.log(p) / width).alias("pb"), F.floor(F.unix_date(d) / (days + 1)).alias("db"))
    left = base.withColumn("pb", F.explode(F.array(*[F.col("pb") + i for i in (-1, 0, 1)]))).withColumn("db", F.explode(F.array(*[F.col("db") + i for i in (-1, 0, 1)])))
    right = base.select(F.col("k").alias("k2"), F.col("p").alias("p2"), F.col("d").alias("d2"), *[F.col(e).alias(f"{e}2") for e in equal], F.col("pb").alias("pb2"), F.col("db").alias("db2"))
    cond = [F.col("pb") == F.col("pb2"), F.col("db") == F.col("db2"), F.col("k") < F.col("k2")] + [F.col(e) == F.col(f"{e}2") for e in equal]
    near = (F.abs(F.col("p") - F.col("p2")) <= F.greatest("p", "p2") * (percent / 100)) & (F.abs(F.datediff("d", "d2")) <= days)
    return left.join(right, cond).filter(near).select(F.col("k").alias("a"), F.col("k2").alias("b"))


def near_anti(left: DataFrame, right: DataFrame, equal: Sequence[str], day: str, days: int = 1) -> DataFrame:
    """Rows of ``left`` without a row of ``right`` that has equal keys and a day at most ``days`` away.

    Right rows are reduced to the first and last day of each bucket of ``days`` + 1 days. A day finds a partner for certain in its own bucket,
    else in the last day of the bucket before or in the first day of the next; so whatever the tolerance, a bucket is held three times.
    """
    bucket = lambda c: F.floor(F.unix_date(c) / (days + 1))
    r = right.select(*[F.col(e).alias(f"__{e}") for e in equal], F.col(day).cast("date").alias("__d")).filter("__d IS NOT NULL")
    keys = [f"__{e}" for e in equal]
    r = r.groupBy(*keys, bucket(F.col("__d")).alias("__b")).agg(F.min("__d").alias("__lo"), F.max("__d").alias("__hi"))
    none = F.lit(None).cast("date")
    at = [F.struct((F.col("__b") + i).alias("b"), own.alias("own"), before.alias("before"), after.alias("after")) for i, own, before, after in (
        (0, F.lit(True), none, none), (1, F.lit(False), F.col("__hi"), none), (-1, F.lit(False), none, F.col("__lo")),
    )]
    r = r.select(*keys, F.explode(F.array(*at)).alias("__at")).groupBy(*keys, F.col("__at.b").alias("__b"))
    r = r.agg(F.bool_or("__at.own").alias("__own"), F.max("__at.before").alias("__before"), F.min("__at.after").alias("__after"))
    d = F.col(day).cast("date")
    near = F.col("__own") | F.coalesce(F.datediff(d, "__before") <= days, F.lit(False)) | F.coalesce(F.datediff("__after", d) <= days, F.lit(False))
    # The merge hint keeps a table that merely packs well from being sent to the driver.
    return left.join(r.hint("merge"), [F.col(e) == F.col(f"__{e}") for e in equal] + [bucket(d) == F.col("__b"), near], "left_anti")


def same_sale(title_a: Column, title_b: Column, players_a: Column, players_b: Column, least: float = 0.3) -> Column:
    """Shared players; if either names none, titles that overlap enough."""
    known = (F.size(players_a) > 0) & (F.size(players_b) > 0)
    return F.when(known, F.arrays_overlap(players_a, players_b)).otherwise(scalars.jaccard(scalars.tokens(title_a), scalars.tokens(title_b)) >= least)


def greedy_groups(rows: DataFrame, pairs: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """(key, group_head): rows in ``order`` join the first group whose first row they match; else they open one. Pairs (a, b) give the matches.

    Each round settles all rows at once whose earlier partners are settled: a row without earlier partners opens a group, which takes its
    later partners out. Nothing but the pairs says who can meet, so no row has to be on one worker with another. Rounds are as many
    as the longest chain of partners that wait for each other, which stays short unless ``order`` follows the values compared.
    """
    at = rows.select(F.col(key).alias("k"), F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate([*order, key])]).alias("o"))
    both = pairs.select("a", "b").filter("a <> b").join(at.toDF("a", "ao"), "a").join(at.toDF("b", "bo"), "b")
    swap = F.col("ao") < F.col("bo")
    edges = staged(both.select(F.when(swap, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(swap, F.col("b")).otherwise(F.col("a")).alias("b"), F.least("ao", "bo").alias("ao")).distinct(), "greedy-pairs")
    left, taken = edges, edges.select("b").limit(0)
    while not left.isEmpty():
        heads = left.select("a").distinct().join(left.select(F.col("b").alias("a")), "a", "left_anti")
        gone = staged(left.join(heads, "a", "left_semi").select("b").distinct(), "greedy-gone")
        taken = taken.union(gone)
        left = staged(left.join(gone, "b", "left_anti").join(gone.toDF("a"), "a", "left_anti"), "greedy-left")
    first = edges.join(taken, "b", "left_semi").join(taken.toDF("a"), "a", "left_anti").groupBy("b").agg(F.min_by("a", "ao").alias("head"))
    return rows.select(key).join(first, F.col(key) == F.col("b"), "left").select(key, F.coalesce("head", key).alias("group_head"))


def resolve(rows: DataFrame, catalog: DataFrame, row_key: str, keys: Sequence[str], rank: Sequence[Column]) -> DataFrame:
    """(row key, card_id, reason): the unique best catalog row over equal keys; ties are refused as ambiguous, none as no_match.

    Catalog rows that differ in nothing but their id are one group, held by its smallest and largest id, since they tie however many there are.
    """
    rest = [x for x in catalog.columns if x not in (*keys, "card_id") and x not in rows.columns]
    ids = ["card_id"] if any("card_id" in str(r).lower() for r in rank) else []  # a rank by ids tells the rows of a group apart
    c = catalog.groupBy(*[F.col(k).alias(f"__{k}") for k in keys], *rest, *ids).agg(F.min("card_id").alias("__lo"), F.max("card_id").alias("__hi"))
    j = rows.join(small_or_merged(c, MAX_BROADCAST_GROUPS), [F.col(k) == F.col(f"__{k}") for k in keys])
    best = j.withColumn("__r", F.rank().over(Window.partitionBy(row_key).orderBy(*rank))).filter("__r = 1")
    best = best.groupBy(row_key).agg(F.lit(True).alias("__met"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
    out = rows.select(row_key).distinct().join(best.hint("merge"), row_key, "left")
    tie = F.col("__lo") != F.col("__hi")
    return out.select(row_key, F.when(~tie, F.col("__lo")).alias("card_id"), F.when(F.col("__met").isNull(), "no_match").when(tie, "ambiguous").otherwise("ok").alias("reason"))


def corroborate(rows: DataFrame, evidence: DataFrame, levels: Sequence[Sequence[str]], value: str) -> DataFrame:
    """The largest evidence at the first level (from narrow to wide keys) that has any, with the level's number."""
    out, picks = rows, []
    for i, keys in enumerate(levels):
        best = evidence.groupBy(*keys).agg(F.max(value).alias(f"__v{i}")).select(*[F.col(k).alias(f"__{i}_{k}") for k in keys], f"__v{i}")
        out = out.join(best, [F.col(k) == F.col(f"__{i}_{k}") for k in keys], "left").drop(*[f"__{i}_{k}" for k in keys])
        picks.append(f"__v{i}")
    level = F.coalesce(*[F.when(F.col(p).isNotNull(), i) for i, p in enumerate(picks)])
    return out.withColumn("corroborated", F.coalesce(*picks)).withColumn("level", level).drop(*picks)
