"""Splitting value ranges into shards of bounded size, from one histogram instead of repeated probing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bisect_shards(rows: DataFrame, value: str, cap: int, low: int, high: int) -> DataFrame:
    """(lo, hi, n, open): halves of the range until at most ``cap`` rows are in each; ``open`` marks unit ranges above the cap.

    The range is [low, low + the power of two that covers high); :func:`outside` counts what lies beyond it. Counts per unit value are summed
    for all levels at once; a node is a shard if it is small enough, or a unit, and its parent is neither.
    """
    levels = max(0, (high - low - 1).bit_length())
    units = rows.filter((F.col(value) >= low) & (F.col(value) < low + 2**levels)).groupBy((F.floor(value) - low).cast("long").alias("u")).agg(F.count(F.lit(1)).alias("n"))
    node = units.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    nodes = node.groupBy("level", F.expr(f"shiftright(u, {levels} - level)").alias("i")).agg(F.sum("n").alias("n"))
    up = nodes.select((F.col("level") + 1).alias("l2"), F.col("i").alias("i2"), F.col("n").alias("above"))
    tree = nodes.join(up, (F.col("level") == F.col("l2")) & (F.expr("shiftright(i, 1)") == F.col("i2")), "left")
    shard = tree.filter(((F.col("n") <= cap) | (F.col("level") == levels)) & (F.col("above").isNull() | (F.col("above") > cap)))
    edge = lambda i: F.expr(f"shiftleft({i}, {levels} - level) + {low}L")
    return shard.select(edge("i").alias("lo"), edge("(i + 1)").alias("hi"), "n", (F.col("n") > cap).alias("open"))


def outside(rows: DataFrame, value: str, low: int, high: int) -> DataFrame:
    """One row (n_below, n_above, n_missing) of the rows that no shard of the same range holds; nothing is lost if all are 0."""
    v, end = F.col(value), low + 2 ** max(0, (high - low - 1).bit_length())
    lost = v.isNull() | F.isnan(v.cast("double"))
    return rows.agg(F.count_if(~lost & (v < low)).alias("n_below"), F.count_if(~lost & (v >= end)).alias("n_above"), F.count_if(lost).alias("n_missing"))


def split_levels(rows: DataFrame, levels: Sequence[str], cap: int) -> DataFrame:
    """(level, path, n, open): rows split by one column after another only where a part is still above ``cap``.

    Such as year, then grading company, then title: a part is final at the first level at which it has at most ``cap`` rows, or at the last,
    where ``open`` marks parts that stay too large. ``path`` lists the values, null being one.
    """
    out = None
    for i in range(len(levels)):
        by = list(levels[: i + 1])
        counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
        if i:
            above = rows.groupBy(*by[:-1]).agg(F.count(F.lit(1)).alias("up")).filter(F.col("up") > cap).select(*[F.col(c).alias(f"__{c}") for c in by[:-1]])
            counts = counts.join(above, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by[:-1]], "left_semi")
        last = i == len(levels) - 1
        part = counts if last else counts.filter(F.col("n") <= cap)
        part = part.select(F.lit(i).alias("level"), F.array(*[F.col(c).cast("string") for c in by]).alias("path"), "n", (F.col("n") > cap).alias("open"))
        out = part if out is None else out.unionByName(part)
    return out


def split_dense(rows: DataFrame, shards: DataFrame, value: str, by: str, cap: int) -> DataFrame:
    """(lo, hi, by, n, passes, residual): unit ranges above the cap split by a category, null being one.

    Each part is read from one end, and from the other end too (``passes`` 2) if it is above the cap; ``residual`` rows in the middle are out of reach.
    """
    dense = shards.filter("open").select("lo", "hi")
    counts = rows.groupBy(F.floor(value).cast("long").alias("__u"), by).agg(F.count(F.lit(1)).alias("n"))
    parts = counts.join(dense, F.col("__u") == F.col("lo"))
    return parts.select("lo", "hi", by, "n", F.when(F.col("n") > cap, 2).otherwise(1).alias("passes"), F.greatest(F.lit(0), F.col("n") - 2 * cap).alias("residual"))
