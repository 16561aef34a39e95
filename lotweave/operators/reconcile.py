"""Diffs between wanted and present rows, guarded merges, undo, set helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff(want: DataFrame, have: DataFrame, key: str, target: str, visible: str) -> DataFrame:
    """(key, action, from_target, to_target): insert, restore, repoint, withdraw or keep, by one full outer join."""
    w = want.select(F.col(key).alias("k"), F.col(target).alias("to_target"))
    h = have.select(F.col(key).alias("hk"), F.col(target).alias("from_target"), F.col(visible).alias("vis"))
    j = w.join(h, F.col("k") == F.col("hk"), "full_outer")
    action = (
        F.when(F.col("hk").isNull(), "insert").when(F.col("k").isNull() & F.col("vis"), "withdraw").when(F.col("k").isNull(), "gone")
        .when(~F.col("to_target").eqNullSafe(F.col("from_target")), "repoint").when(~F.col("vis"), "restore").otherwise("keep")
    )
    return j.select(F.coalesce("k", "hk").alias(key), action.alias("action"), "from_target", "to_target").filter("action <> 'gone'")


def redirects(plan: DataFrame) -> DataFrame:
    """(from_target, to_target) where all of a target's rows moved to one other and none was withdrawn."""
    g = plan.filter("from_target IS NOT NULL").groupBy("from_target").agg(
        F.count_distinct(F.when(F.col("action") == "repoint", F.col("to_target"))).alias("n_to"), F.count_if(F.col("action") != "repoint").alias("others"),
        F.max(F.when(F.col("action") == "repoint", F.col("to_target"))).alias("to_target"),
    )
    return g.filter("n_to = 1 AND others = 0").select("from_target", "to_target")


def merge_tags(rows: DataFrame, manifest: DataFrame, key: str, tags: str, tag: str, run: str) -> DataFrame:
    """Set ``tag`` in the map column ``tags`` from the manifest (key, value) where it isn't set yet, marked with ``run``."""
    m = manifest.select(F.col(key).alias("__k"), F.col("value").alias("__v"))
    j = rows.join(m, F.col(key) == F.col("__k"), "left")
    have = F.coalesce(F.col(tags), F.create_map().cast("map<string,string>"))
    add = F.create_map(F.lit(tag), F.col("__v"), F.lit(f"{tag}_run"), F.lit(run))
    return j.withColumn(tags, F.when(F.col("__v").isNotNull() & ~F.map_contains_key(have, F.lit(tag)), F.map_concat(have, add)).otherwise(F.col(tags))).drop("__k", "__v")


def undo_tags(rows: DataFrame, tags: str, tag: str, run: str) -> DataFrame:
    """Remove what :func:`merge_tags` set in that run."""
    mine = F.try_element_at(F.col(tags), F.lit(f"{tag}_run")) == run
    return rows.withColumn(tags, F.when(mine, F.map_filter(tags, lambda k, v: ~k.isin(tag, f"{tag}_run"))).otherwise(F.col(tags)))


def upsert(old: DataFrame, new: DataFrame, key: str, once: Sequence[str] = ()) -> DataFrame:
    """New values over old ones; columns in ``once`` keep the old value if there is one (ids are minted once)."""
    n = new.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in new.columns if c != key])
    j = old.withColumn("__old", F.lit(True)).join(n, F.col(key) == F.col("__k"), "full_outer")
    cols = [F.coalesce(key, "__k").alias(key)]
    for c in old.columns:
        if c != key:
            fresh = F.when(F.col("__k").isNotNull(), F.col(f"__{c}")).otherwise(F.col(c)) if c in new.columns else F.col(c)
            cols.append((F.coalesce(F.col(c), fresh) if c in once else fresh).alias(c))
    return j.select(*cols)


def revert(table: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Rows as a backup has them; rows that it doesn't name stay."""
    return table.join(before.select(key), key, "left_anti").unionByName(before, allowMissingColumns=True)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two results hold the same rows, repeats counted."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
