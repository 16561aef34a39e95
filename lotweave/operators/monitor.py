"""Aggregates and windows that watch the lake: audits, overlap, freshness, tiers, streaks, guards, ledgers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered


def audit(rows: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows, and how many meet each condition, in one pass."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(n) for n, c in checks.items()])


def histograms(rows: DataFrame, buckets: Mapping[str, Column]) -> DataFrame:
    """(name, bucket, n): one histogram per name, null buckets as empty text, all from one pass over the rows."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.coalesce(c.cast("string"), F.lit("")).alias("bucket")) for n, c in buckets.items()]))
    return rows.select(each.alias("h")).groupBy("h.name", "h.bucket").agg(F.count(F.lit(1)).alias("n"))


def store_audit(rows: DataFrame, key: str, price: Column, flags: Mapping[str, Column]) -> DataFrame:
    """One row of counts: rows, without key, distinct keys, repeats, prices present, zero or missing and their sum, and each flag."""
    p = price.cast("double")
    facts = {"no_id": F.col(key).isNull(), "price_ok": p > 0, "price_zero": p <= 0, "price_missing": p.isNull(), **flags}
    per = rows.groupBy(F.col(key).alias("__k")).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(F.when(p > 0, p.cast("decimal(28,6)"))).alias("__sum"), *[F.count_if(c).alias(f"__{n}") for n, c in facts.items()]
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    known = F.col("__k").isNotNull()
    return per.agg(
        total("__n").alias("rows"), F.count_if(known).alias("unique_ids"), total(F.when(known, F.col("__n") - 1)).alias("intra_dupes"),
        F.coalesce(F.sum("__sum"), F.lit(0)).cast("double").alias("price_sum"), *[total(f"__{n}").alias(n) for n in facts],
    )


def totals(rows: DataFrame, by: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    """Rows and distinct values of some columns per group."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.count_distinct(c).alias(f"n_{c}") for c in distinct])


def shrink_verdict(before: DataFrame, after: DataFrame, by: str, floor: int, share: float = 0.1) -> DataFrame:
    """One row (n_before, n_after, refuse, groups): refused if the total, or any group of at least ``floor``, lost more than ``share``."""
    g = shrink_guard(before, after, by, floor, share)
    shrunk = F.sort_array(F.collect_list(F.when(F.col("refuse"), F.col(by).cast("string"))))
    out = g.agg(F.coalesce(F.sum("n_before"), F.lit(0)).alias("n_before"), F.coalesce(F.sum("n_after"), F.lit(0)).alias("n_after"), shrunk.alias("groups"))
    return out.withColumn("refuse", (F.size("groups") > 0) | (F.col("n_after") < F.col("n_before") * (1 - share)))


def yields(rows: DataFrame, by: Sequence[str], got: str) -> DataFrame:
    """Runs per group with mean and median of what they yielded."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_runs"), F.avg(got).alias("mean"), F.median(got).alias("median"))


def tier_load(items: DataFrame, tier: str, days: Mapping[str, float]) -> DataFrame:
    """(tier, n, per_day): members of each tier, and how many are due a day if each is read every so many days."""
    every = F.try_element_at(F.create_map(*[F.lit(x) for t, d in days.items() for x in (t, float(d))]), F.col(tier))
    return items.groupBy(tier).agg(F.count(F.lit(1)).alias("n")).withColumn("per_day", F.col("n") / every)


def overlap_bitmask(rows: DataFrame, key: str, bit: Column) -> DataFrame:
    """How many keys occur in exactly which of the inputs; ``bit`` is 1, 2, 4, ... by input."""
    return rows.groupBy(key).agg(F.bit_or(bit).alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("n_keys"))


def freshness(rows: DataFrame, by: str, day: str, as_of: Column, warn: int, stale: int) -> DataFrame:
    out = rows.groupBy(by).agg(F.max(F.col(day).cast("date")).alias("last_day"), F.count(F.lit(1)).alias("n_rows"))
    lag = F.datediff(as_of, "last_day")
    return out.withColumn("lag_days", lag).withColumn("status", F.when(lag.isNull(), "empty").when(lag > stale, "stale").when(lag > warn, "late").otherwise("fresh"))


def activity_tiers(rows: DataFrame, item: str, variant: str, floors: Sequence[tuple[int, str]], default: str) -> DataFrame:
    """The busiest variant's count per item, and the first tier whose floor it reaches."""
    top = rows.groupBy(item, variant).agg(F.count(F.lit(1)).alias("n")).groupBy(item).agg(F.max("n").alias("top_count"))
    tier = F.lit(default)
    for floor, name in reversed(floors):
        tier = F.when(F.col("top_count") >= floor, name).otherwise(tier)
    return top.withColumn("tier", tier)


def streaks(events: DataFrame, by: Sequence[str], order: Sequence[str], failed: Column, segment: Column | None = None) -> DataFrame:
    """Every event with the length of the run of failures that ends there (0 after a success). ``segment``: see :mod:`.ordered`."""
    bad = F.coalesce(failed, F.lit(False))
    out = ordered.running(events, by, order, {"__bad": bad.cast("long")}, segment)
    out = ordered.last_known(out, by, order, F.when(~bad, F.col("__bad")), "__at_success", segment)
    return out.withColumn("streak", F.col("__bad") - F.coalesce("__at_success", F.lit(0))).drop("__bad", "__at_success")


def rolling_failures(events: DataFrame, by: Sequence[str], order: Sequence[str], failed: Column, size: int = 300, most: int = 120, segment: Column | None = None) -> DataFrame:
    """Failures among the last ``size`` events; ``stop`` only once there are so many events and more than ``most`` failed."""
    out = ordered.rolling_sum(events, by, order, F.coalesce(failed, F.lit(False)).cast("long"), size, "recent_failures", segment)
    return out.withColumn("stop", (F.col("recent_failures_rows") >= size) & (F.col("recent_failures") > most)).drop("recent_failures_rows")


def latch(samples: DataFrame, by: Sequence[str], order: Sequence[str], level: Column, on: float, off: float, segment: Column | None = None) -> DataFrame:
    """Hysteresis: on from ``on`` up, off from ``off`` down, between them as before (off at the start)."""
    out = ordered.last_known(samples, by, order, F.when(level >= on, True).when(level <= off, False), "latched", segment)
    return out.withColumn("latched", F.coalesce("latched", F.lit(False)))


def shrink_guard(before: DataFrame, after: DataFrame, by: str, floor: int, share: float = 0.1) -> DataFrame:
    """Counts per group of two versions; ``refuse`` where a group of at least ``floor`` lost more than ``share``."""
    b = before.groupBy(by).agg(F.count(F.lit(1)).alias("n_before"))
    a = after.groupBy(F.col(by).alias("__by")).agg(F.count(F.lit(1)).alias("n_after"))
    out = b.join(a, F.col(by).eqNullSafe(F.col("__by")), "full_outer")
    out = out.select(F.coalesce(by, "__by").alias(by), F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))
    return out.withColumn("refuse", (F.col("n_before") >= floor) & (F.col("n_after") < F.col("n_before") * (1 - share)))


def latest(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key, by a total order; narrow aggregates instead of a sort of whole groups."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__l")).select(*keys, *[F.col(f"__l.{c}").alias(c) for c in rest])


def ledger_rollup(log: DataFrame, by: Sequence[str], status: str, at: str, done: str) -> DataFrame:
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("n_runs"), F.max(at).alias("last_at"), F.max(F.when(F.col(status) == done, F.col(at))).alias("last_done"))


def rate(rows: DataFrame, by: Sequence[str], bad: Column, good: Column) -> DataFrame:
    """bad / (bad + good) per group; null without either."""
    out = rows.groupBy(*by).agg(F.count_if(bad).alias("n_bad"), F.count_if(good).alias("n_good"))
    return out.withColumn("rate", F.try_divide("n_bad", F.col("n_bad") + F.col("n_good")))


def verdict(checks: DataFrame, severity: str = "severity", reason: str = "reason") -> DataFrame:
    """The worst severity and the reasons at that level."""
    return checks.agg(F.max(severity).alias("worst"), F.sort_array(F.collect_list(F.when(F.col(severity) > 0, F.col(reason)))).alias("reasons"))


def carry_forward(lines: DataFrame, order: str, stamped: Column, by: Sequence[str] = (), segment: Column | None = None) -> DataFrame:
    """The last stamp seen up to each line."""
    return ordered.last_known(lines, by, [order], stamped, "stamp", segment)


def majority(rows: DataFrame, subject: str, label: str) -> DataFrame:
    """(subject, label, votes, total, share): the most frequent label, ties by name."""
    votes = rows.filter(F.col(subject).isNotNull()).groupBy(subject, label).agg(F.count(F.lit(1)).alias("votes"))
    first = F.min(F.struct((-F.col("votes")).alias("v"), F.col(label).alias("l")))
    out = votes.groupBy(subject).agg(first.alias("__b"), F.sum("votes").alias("total"))
    out = out.select(subject, F.col("__b.l").alias(label), (-F.col("__b.v")).alias("votes"), "total")
    return out.withColumn("share", F.col("votes") / F.col("total"))


def confidence(share: Column, total: Column, explicit: Column) -> Column:
    return F.when(explicit.isNotNull(), "HIGH").when((share >= 0.8) & (total >= 20), "MEDIUM").when((share >= 0.5) & (total >= 5), "LOW").otherwise("NONE")


def paired(lines: DataFrame, by: Sequence[str], order: str, opens: Column, closes: Column, segment: Column | None = None) -> DataFrame:
    """(keys, opened, closed): each closing line's ``order`` with that of the latest opening line since the closing one before.

    Closing lines without such an opening one go. Lines are numbered by the closings before them, so the pairs are groups, not a window over a key.
    """
    marked = lines.select(*by, order, opens.alias("__o"), closes.alias("__c"), (F.lit(0) if segment is None else segment).alias("__s")).filter("__o OR __c")
    run = ordered.running(marked, by, [order], {"__upto": F.col("__c").cast("int")}, None if segment is None else F.col("__s"))
    turn = run.withColumn("__turn", F.col("__upto") - F.col("__c").cast("int"))
    pairs = turn.groupBy(*by, "__turn").agg(F.max(F.when(F.col("__o") & ~F.col("__c"), F.col(order))).alias("opened"), F.max(F.when(F.col("__c"), F.col(order))).alias("closed"))
    return pairs.filter("opened IS NOT NULL AND closed IS NOT NULL").drop("__turn")
