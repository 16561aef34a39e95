"""Vocabulary of titles: how often words occur, how often first, and which words tell groups apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mine(rows: DataFrame, words: Column, floor: int = 5, leading: float = 0.5) -> DataFrame:
    """(token, n, n_first, role): words of at least ``floor`` occurrences; ``lead`` if so large a share opens a title, else ``inner``."""
    each = rows.select(F.posexplode(words).alias("at", "token"))
    out = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("at") == 0).alias("n_first")).filter(F.col("n") >= floor)
    return out.withColumn("role", F.when(F.col("n_first") >= leading * F.col("n"), "lead").otherwise("inner"))


def discriminators(rows: DataFrame, words: Column, group: str, share: float = 0.8, floor: int = 5) -> DataFrame:
    """(token, group, n, n_group): words of which one group holds at least ``share``."""
    counts = rows.filter(F.col(group).isNotNull()).select(F.col(group).alias("g"), F.explode(F.array_distinct(words)).alias("token"))
    counts = counts.groupBy("token", "g").agg(F.count(F.lit(1)).alias("c"))
    best = F.min(F.struct((-F.col("c")).alias("c"), F.col("g").alias("g")))
    out = counts.groupBy("token").agg(F.sum("c").alias("n"), best.alias("b")).filter(F.col("n") >= floor)
    out = out.select("token", F.col("b.g").alias(group), "n", (-F.col("b.c")).alias("n_group"))
    return out.filter(F.col("n_group") >= share * F.col("n"))


def unanimous(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) where all values of a key that aren't null agree."""
    out = rows.groupBy(key).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    return out.filter(F.col("__lo") == F.col("__hi")).select(key, F.col("__lo").alias(value))
