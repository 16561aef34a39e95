"""Which pictures may be served: by list, by ledger, by what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import listings, rules


def _marked(rows: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``rows`` with a flag whether ``other`` has their keys."""
    known = other.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct().withColumn(name, F.lit(True))
    out = rows.join(known, [F.col(k) == F.col(f"__{k}") for k in keys], "left").drop(*[f"__{k}" for k in keys])
    return out.withColumn(name, F.coalesce(name, F.lit(False)))


def public(rows: DataFrame, listed: DataFrame | None, sources: Sequence[str], whole: Sequence[str] = (), open_without_list: Sequence[str] = ()) -> DataFrame:
    """``rows`` (source, key) with allowed and reason. ``listed`` is the list of (source, key), or None if there is none."""
    source = F.col("source")
    out = rows.withColumn("__listed", F.lit(False)) if listed is None else _marked(rows, listed, ["source", "key"], "__listed")
    bad = source.isNull() | ~source.isin(*sources) | ~listings.key_ok(F.col("key"))
    last = F.when(source.isin(*open_without_list), "no_list_open_source").otherwise("no_list_closed") if listed is None else F.lit("unlisted")
    reason = F.when(bad, "bad_request").when(source.isin(*whole), "curated_source").when(F.col("__listed"), "listed").otherwise(last)
    return out.withColumn("reason", reason).withColumn("allowed", F.col("reason").isin("curated_source", "listed", "no_list_open_source")).drop("__listed")


def usable(rows: DataFrame, ledger: DataFrame, stored: DataFrame, url: str, prefix: str) -> DataFrame:
    """``rows`` with key, state and kept, from the latest ``ledger`` (key, status) and the ``stored`` keys.

    The ledger has one row per key (:func:`lotweave.operators.monitor.latest`). Dead keys go, the ledger's own word is enough for ``ok``
    and ``skip``, all others must be stored.
    """
    u = F.trim(F.coalesce(url, F.lit("")))
    keyed = rows.withColumn("key", F.when(u.startswith(prefix), F.regexp_replace(F.substring(u, F.lit(len(prefix) + 1), F.length(u)), "^/+|/+$", "")))
    said = ledger.select(F.col("key").alias("__key"), F.col("status").alias("__status"))
    both = _marked(keyed.join(said, F.col("key") == F.col("__key"), "left").drop("__key"), stored, ["key"], "__stored")
    state = rules.first_of([
        (F.col("key").isNull(), "other_route"), (F.col("__status") == "dead", "dead"),
        (F.col("__status").isin("ok", "skip"), "by_ledger"), (F.col("__stored"), "by_store"),
    ], "not_stored")
    return both.withColumn("state", state).withColumn("kept", F.col("state").isin("by_ledger", "by_store")).drop("__status", "__stored")
