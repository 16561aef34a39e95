"""Mixing sources to target weights by hash-threshold histograms.

Tokens are summed by (source, hash bucket); prefix sums over the buckets find, for each source, the bucket in which its
budget ends; only that bucket is summed again on the next twelve bits of the hash. What comes out is one threshold per
source, so documents are chosen by a comparison, without sorting them and without a document ever meeting another.

Nulls: a null text has size 0, a null source is a source of its own (ordered last), a null id hashes as the empty text.
Rows with the same id are taken or left together, so ties of hashes need no rule. Whole texts of any length are counted. An empty
table gives an empty result. Other columns are kept by :func:`apply_mix`, whatever they are called, and are ignored by :func:`mix_sizes`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ordered
from . import shared

#: Bits of the hash that each histogram adds, in hexadecimal digits.
DIGITS = 3
STEP = 16**DIGITS
LEVELS = 2
SPACE = STEP**LEVELS
#: One row per source joins by broadcast up to this many sources; beyond, the join is shuffled.
MAX_BROADCAST_SOURCES = 100_000


def mix_hash(id_col: str) -> Column:
    """The leading 24 bits of the id's MD5, as long."""
    return F.conv(F.substring(F.md5(shared.id_text(id_col)), 1, DIGITS * LEVELS), 16, 10).cast("long")


def source_targets(by_source: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Targets from (source, source_size): water-filling of ``share`` times all sizes, capped at ``most`` times each.

    Sources by code point, null last, get the weights in turn. Sharing the excess by weight until no source is above its
    cap ends at min(cap, level * weight); ordered by cap/weight, the level follows from prefix sums. There may be a source per
    host, so ranks and prefix sums run within ranges of sources that tasks hold, each of which hands one small row to the next.
    """
    nth = ordered.ranged_running(by_source, [F.col("source").asc_nulls_last()], {"nth": F.lit(1)}, "mix-sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("nth") - 1) % len(weights) + 1).cast("int"))
    t = nth.withColumn("w", w).drop("nth").withColumn("cap", F.col("source_size") * F.lit(float(most)))
    t = t.withColumn("full_at", F.col("cap") / F.col("w"))
    order = [F.col("full_at"), F.col("source").asc_nulls_last()]
    t = ordered.ranged_running(t, order, {"nth": F.lit(1), "caps": F.col("cap"), "ws": F.col("w")}, "mix-caps")
    whole = F.broadcast(t.agg((F.sum("source_size") * F.lit(float(share))).alias("budget"), F.sum("w").alias("all_w")))
    t = t.crossJoin(whole)  # one row
    level = (F.col("budget") - (F.col("caps") - F.col("cap"))) / (F.col("all_w") - (F.col("ws") - F.col("w")))
    t = shared.staged(t.withColumn("level", level), "mix-levels")
    first = t.agg(F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("nth", "level"))).alias("first"))
    target = F.least("cap", F.coalesce(F.col("first.level") * F.col("w"), F.col("cap")))
    return t.crossJoin(F.broadcast(first)).select("source", "source_size", target.alias("target"))  # one row


def thresholds(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target, whole, below): take each document ``whole`` times, and once more if hash < below.

    ``sized`` has (source, h, size) and is read once per level.
    """
    hist = shared.staged(
        sized.groupBy("source", F.floor(F.col("h") / STEP).alias("bucket")).agg(F.sum("size").alias("size")), "mix-histogram"
    )
    by_source = hist.groupBy("source").agg(F.sum("size").alias("source_size"))
    files = max(1, -(-by_source.count() // ordered.ROWS_PER_RANGE))  # the tables from here on have one row per source
    targets = source_targets(by_source, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    state = targets.withColumn("prefix", F.lit(0).cast("long")).withColumn("base", F.lit(0).cast("long"))
    state = shared.staged(state.coalesce(files), "mix-targets")
    for level in range(LEVELS):
        if level:
            width = STEP ** (LEVELS - 1 - level)
            inside = sized.withColumn("parent", F.floor(F.col("h") / (width * STEP)))
            edge = state.filter("open").select(F.col("source").alias("s"), "prefix")
            inside = inside.join(
                shared.small_enough(edge, MAX_BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("s")) & (F.col("parent") == F.col("prefix"))
            )
            hist = inside.groupBy("source", F.floor(F.col("h") / width).alias("bucket")).agg(F.sum("size").alias("size"))
        state = shared.staged(_boundary(hist, state, last=level == LEVELS - 1).repartition(files), "mix-boundary")
    below = F.when(F.col("rest") <= 0, 0).when(F.col("open"), F.col("prefix")).otherwise(SPACE)
    return state.select("source", "source_size", "target", "whole", below.cast("long").alias("below"))


def _boundary(hist: DataFrame, state: DataFrame, last: bool) -> DataFrame:
    """Per source, the bucket in which its rest ends (``prefix``) and the tokens before it (``base``)."""
    hist = hist.select(F.col("source").alias("hs"), "bucket", "size")
    base = state.drop("prefix", "open")
    run = Window.partitionBy("hs").orderBy("bucket")
    sums = hist.withColumn("upto", F.sum("size").over(run))
    j = sums.join(base, F.col("hs").eqNullSafe(F.col("source")))
    upto, start = F.col("base") + F.col("upto"), F.col("base") + F.col("upto") - F.col("size")
    over = upto > F.col("rest")
    end = F.col("bucket")
    if last:  # the edge goes to the nearer side of the last bucket
        end = F.when(F.col("rest") - start <= upto - F.col("rest"), F.col("bucket")).otherwise(F.col("bucket") + 1)
    first = F.min(F.when(over, F.struct(F.col("bucket"), start.alias("start"), end.alias("end"))))
    found = j.groupBy("hs").agg(first.alias("edge"))
    out = base.join(found, F.col("hs").eqNullSafe(F.col("source")), "left")
    return out.select(
        "source", "source_size", "target", "whole", "rest",
        F.coalesce("edge.end" if last else "edge.bucket", F.lit(0)).cast("long").alias("prefix"),
        F.coalesce("edge.start", F.col("base")).cast("long").alias("base"),
        F.col("edge").isNotNull().alias("open"),
    )


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``; ``how`` goes to :func:`thresholds`."""
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), shared.words_of(text_col).alias("size"), mix_hash(id_col).alias("h"))
    sized = shared.staged(sized, "mix-sizes")
    plan = thresholds(sized, **how).withColumnRenamed("source", "s")
    out = sized.join(shared.small_enough(plan, MAX_BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("s")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies()).alias("taken"))


def copies() -> Column:
    """How often a row is taken, from the columns of :func:`thresholds` and ``h``."""
    return F.col("whole") + F.when(F.col("h") < F.col("below"), 1).otherwise(0)


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mixed corpus: rows of ``docs`` (all their columns), repeated as often as the mix takes them.

    Texts aren't shuffled: sizes are summed in a first pass, the second compares each row's hash with its source's threshold.
    """
    sized = docs.select(F.col(source_col).alias("source"), shared.words_of(text_col).alias("size"), mix_hash(id_col).alias("h"))
    plan = thresholds(shared.staged(sized, "mix-sizes"), **how)
    mix, copy = shared.fresh(docs.columns, "mix"), shared.fresh(docs.columns, "copy")
    plan = shared.staged(plan.select(F.struct("source", "whole", "below").alias(mix)), "mix-plan")
    out = docs.join(shared.small_enough(plan, MAX_BROADCAST_SOURCES), F.col(source_col).eqNullSafe(F.col(f"{mix}.source")))
    times = F.col(f"{mix}.whole") + F.when(mix_hash(id_col) < F.col(f"{mix}.below"), 1).otherwise(0)
    out = out.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times.cast("int"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
