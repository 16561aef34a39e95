"""Run control from ledgers: what is unfinished, due, allowed, over budget, and how a machine or feed is doing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from .monitor import latest

#: Statuses of a run that need no further work.
DONE = ["completed", "empty", "skipped"]
#: States of a source in which it must not be contacted.
BARRED = ["paused", "blocked", "disabled"]


def unfinished(planned: DataFrame, log: DataFrame, keys: Sequence[str], order: Sequence[str], status: str = "status", done: Sequence[str] = tuple(DONE)) -> DataFrame:
    """Planned windows whose latest run isn't done, with that run's status (null: never run)."""
    last = latest(log.select(*keys, *order, status), keys, order).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(status).alias("last_status"))
    out = planned.join(last, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left").drop(*[f"__{k}" for k in keys])
    return out.filter(F.col("last_status").isNull() | ~F.col("last_status").isin(list(done)))


def due(items: DataFrame, log: DataFrame, ring: str, item: str, at: str, as_of: Column, every_days: float, slack: float = 1.5) -> DataFrame:
    """Per ring: members, those done since the ring's pass began, and whether it is due.

    Only members count as done. A ring is due when its pass is complete and ``every_days`` passed since it began, or in any case after ``slack``
    times that, or if it never ran.
    """
    seen = log.select(F.col(item).alias("__i"), F.col(at).alias("__at")).groupBy("__i").agg(F.max("__at").alias("__at"))
    out = items.join(seen, F.col(item) == F.col("__i"), "left").groupBy(ring)
    out = out.agg(F.count(F.lit(1)).alias("n_items"), F.count("__at").alias("n_done"), F.min("__at").alias("began"))
    age = (F.unix_timestamp(as_of) - F.unix_timestamp("began")) / 86400
    is_due = F.col("began").isNull() | ((F.col("n_done") == F.col("n_items")) & (age >= every_days)) | (age >= slack * every_days)
    return out.withColumn("due", is_due)


def pass_due(items: DataFrame, log: DataFrame, passes: DataFrame, ring: str, item: str, at: str, as_of: Column, every_hours: float, slack: float = 1.5) -> DataFrame:
    """Per ring: members, those done in its present pass, and whether a new pass begins or this one goes on.

    ``passes`` (ring, began) says when each ring's pass began; visits before that are of an earlier pass and count for nothing, like those of items that
    are no longer members. ``state``: new_pass if none began yet, if it is complete and ``every_hours`` passed since it began, or in any case after
    ``slack`` times that; complete if nothing is left until then; else reading.
    """
    began = passes.groupBy(F.col(ring).alias("__ring")).agg(F.max("began").alias("began"))
    members = items.select(ring, item).distinct().join(began, F.col(ring) == F.col("__ring"), "left").drop("__ring")
    seen = log.select(F.col(item).alias("__i"), F.col(at).alias("__at")).groupBy("__i").agg(F.max("__at").alias("__at"))
    done = F.col("__at") >= F.col("began")
    out = members.join(seen, F.col(item) == F.col("__i"), "left").groupBy(ring)
    out = out.agg(F.count(F.lit(1)).alias("n_items"), F.count_if(F.coalesce(done, F.lit(False))).alias("n_done"), F.max("began").alias("began"))
    age = (F.unix_timestamp(as_of) - F.unix_timestamp("began")) / 3600
    whole = F.col("n_done") >= F.col("n_items")
    new = F.col("began").isNull() | (whole & (age > every_hours)) | (age > slack * every_hours)
    return out.withColumn("state", F.when(new, "new_pass").when(whole, "complete").otherwise("reading"))


#: Which status of a run may follow which.
STEPS = {
    "planned": ["running", "skipped"], "running": ["completed", "empty", "failed", "blocked", "paused", "partial"], "partial": ["running", "failed", "completed"],
    "failed": ["running", "skipped"], "blocked": ["running", "paused"], "paused": ["running"], "completed": [], "empty": [], "skipped": [],
}


def bad_steps(log: DataFrame, keys: Sequence[str], order: Sequence[str], status: str = "status", steps: dict[str, list[str]] = STEPS) -> DataFrame:
    """(keys, order, from_status, status): entries of a log that don't follow from the one before; a log begins with ``planned`` or ``running``."""
    from pyspark.sql import Window

    before = F.lag(status).over(Window.partitionBy(*keys).orderBy(*order))
    may = F.lit(False)
    for first, after in steps.items():
        if after:
            may = may | ((F.col("from_status") == first) & F.col(status).isin(after))
    out = log.select(*keys, *order, before.alias("from_status"), status)
    begins = F.col("from_status").isNull() & F.col(status).isin("planned", "running")
    return out.filter(~F.coalesce(begins | may, F.lit(False)))


def contact_allowed(state: Column, retry_at: Column, as_of: Column) -> Column:
    """Neither barred nor before its time; an unknown source may be contacted."""
    return ~F.coalesce(state, F.lit("")).isin(BARRED) & (retry_at.isNull() | (retry_at <= as_of))


def budget(log: DataFrame, by: str, at: str, limit: int) -> DataFrame:
    """Requests per source and day, what is left of the day's ``limit``, and whether it is spent."""
    out = log.groupBy(by, F.to_date(at).alias("day")).agg(F.count(F.lit(1)).alias("used"))
    return out.withColumn("left", F.greatest(F.lit(0), F.lit(limit) - F.col("used"))).withColumn("spent", F.col("used") >= limit)


def levels(samples: DataFrame, by: Sequence[str], limits: Sequence[tuple[str, float, float]]) -> DataFrame:
    """Per group the worst level of several measures: 0 fine, 1 from the first limit, 2 from the second; and which measures are at it."""
    each = [F.when(F.max(m) >= high, 2).when(F.max(m) >= low, 1).otherwise(0).alias(f"__{m}") for m, low, high in limits]
    out = samples.groupBy(*by).agg(*each)
    worst = F.greatest(*[F.col(f"__{m}") for m, _, _ in limits]) if len(limits) > 1 else F.col(f"__{limits[0][0]}")
    causes = rules.all_reasons([((F.col(f"__{m}") == F.col("level")) & (F.col("level") > 0), m) for m, _, _ in limits])
    return out.withColumn("level", worst).withColumn("causes", F.array_join(causes, ",")).drop(*[f"__{m}" for m, _, _ in limits])


def overlap_reread(rows: DataFrame, at: str, mark: Column, days: int, known: DataFrame, key: str) -> DataFrame:
    """Rows from ``days`` before the mark on, without those already known: late rows are found, repeated ones dropped."""
    k = known.select(F.col(key).alias("__k"))
    return rows.filter(F.col(at) >= mark - F.make_dt_interval(F.lit(days))).join(k, F.col(key) == F.col("__k"), "left_anti")
