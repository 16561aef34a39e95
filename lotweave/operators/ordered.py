"""Ordered computations for keys of any size: running sums, ordinals, last known values, rolling sums, exact medians.

A plain ordered window puts a whole key into one task. Here a key is cut into segments by a Column that never falls along the order (a day, a
price step): windows run within (key, segment), one small row per segment carries what came before. Without a segment the whole
key is one. Null keys group together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import staging

SEGMENT = "__segment"
ROWS_PER_RANGE = 200_000


def _cut(rows: DataFrame, segment: Column | None) -> DataFrame:
    return rows.withColumn(SEGMENT, F.lit(0) if segment is None else segment)


def _beside(rows: DataFrame, parts: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``parts`` of the same keys, nulls being equal."""
    p = parts.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    return rows.join(p, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys], how).drop(*[f"__of_{k}" for k in keys])


def _earlier(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)


def running(rows: DataFrame, by: Sequence[str], order: Sequence[str | Column], sums: Mapping[str, Column], segment: Column | None = None) -> DataFrame:
    """``rows`` with the sum of each column of ``sums`` from its key's first row up to this one. ``order`` must be total."""
    out = _cut(rows, segment).withColumns({f"__x_{n}": F.coalesce(c, F.lit(0)) for n, c in sums.items()})
    w = Window.partitionBy(*by, SEGMENT).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = out.withColumns({n: F.sum(f"__x_{n}").over(w) for n in sums}).drop(*[f"__x_{n}" for n in sums])
    if segment is None:
        return inside.drop(SEGMENT)
    parts = out.groupBy(*by, SEGMENT).agg(*[F.sum(f"__x_{n}").alias(f"__b_{n}") for n in sums])
    parts = parts.select(*by, SEGMENT, *[F.coalesce(F.sum(f"__b_{n}").over(_earlier(by)), F.lit(0)).alias(f"__b_{n}") for n in sums])
    done = _beside(inside, parts, [*by, SEGMENT])
    return done.withColumns({n: F.col(n) + F.col(f"__b_{n}") for n in sums}).drop(SEGMENT, *[f"__b_{n}" for n in sums])


def ordinals(rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "ordinal", segment: Column | None = None) -> DataFrame:
    """``rows`` with their number within the key, from 1."""
    return running(rows, by, order, {name: F.lit(1)}, segment)


def ranged_running(rows: DataFrame, order: Sequence[Column], sums: Mapping[str, Column], name: str = "ranged") -> DataFrame:
    """``rows`` with running sums along ``order``, which is total, over the whole table: for values without a natural segment.

    Rows are dealt to tasks by ranges of ``order``, as many as their number calls for; the range is the segment, and is stored with the rows so
    that it stays what it was.
    """
    n = max(1, -(-rows.count() // ROWS_PER_RANGE))
    ranges = rows.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id())
    return running(staging.staged(ranges, name), [], order, sums, F.col("__range")).drop("__range")


def last_known(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str, segment: Column | None = None) -> DataFrame:
    """``rows`` with the latest value that isn't null, of this row or one before."""
    out = _cut(rows, segment).withColumn("__v", value)
    w = Window.partitionBy(*by, SEGMENT).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = out.withColumn(name, F.last("__v", ignorenulls=True).over(w)).drop("__v")
    if segment is None:
        return inside.drop(SEGMENT)
    parts = out.groupBy(*by, SEGMENT).agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(*order))).alias("__b"))
    parts = parts.select(*by, SEGMENT, F.last("__b", ignorenulls=True).over(_earlier(by)).alias("__b"))
    return _beside(inside, parts, [*by, SEGMENT]).withColumn(name, F.coalesce(name, "__b")).drop(SEGMENT, "__b")


def rolling_sum(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, size: int, name: str, segment: Column | None = None) -> DataFrame:
    """``rows`` with the sum over the last ``size`` rows and, as ``<name>_rows``, how many rows of the key there are so far.

    It is the difference of two running sums ``size`` rows apart, which an equi-join on (key, number) brings together.
    """
    run = running(rows, by, order, {"__n": F.lit(1), "__s": value}, segment)
    old = run.select(*by, (F.col("__n") + size).alias("__n"), F.col("__s").alias("__old"))
    out = _beside(run, old, [*by, "__n"])
    return out.withColumn(name, F.col("__s") - F.coalesce("__old", F.lit(0))).withColumnRenamed("__n", f"{name}_rows").drop("__s", "__old")


def medians(rows: DataFrame, by: Sequence[str], value: str, step: float = 100.0) -> DataFrame:
    """(keys, n, mid): the exact median of each key from counts per distinct value, in segments of ``step``; nulls don't count."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__c"))
    run = running(counts, by, [value], {"__upto": F.col("__c")}, F.floor(F.col(value) / step))
    n = counts.groupBy(*by).agg(F.sum("__c").alias("n"))
    both = _beside(run, n, by, "inner")
    lower, upper = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    ends = both.groupBy(*by, "n").agg(F.min(F.when(F.col("__upto") >= lower, F.col(value))).alias("__l"), F.min(F.when(F.col("__upto") >= upper, F.col(value))).alias("__u"))
    return ends.select(*by, "n", (F.col("__l") + (F.col("__u") - F.col("__l")) / 2).alias("mid"))
