"""Categories from ordered evidence: rules over the title, then what a subject's other titles say, then the brand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from .monitor import confidence, majority

Rules = Sequence[tuple[str, str]]


def classify(rows: DataFrame, title: str, subject: str, category: Rules, default: str, kinds: Rules, brand: str, leanings: Rules, least: float = 0.5, floor: int = 5) -> DataFrame:
    """``rows`` with category, kind, method and confidence.

    A title that a ``category`` rule matches isn't of the ``default`` category and has no kind (method category). Else its kind comes from
    the first ``kinds`` rule (explicit), or its subject's majority among explicit titles, if that has ``least`` of at least ``floor``
    (subject), or the first rule of ``leanings`` over the brand (brand). The majority is counted over all rows; ties go by name.
    """
    low = F.lower(F.coalesce(F.col(title), F.lit("")))
    out = rows.withColumn("category", rules.first_match(low, category, default))
    out = out.withColumn("__explicit", F.when(F.col("category") == default, rules.first_match(low, kinds)))
    votes = majority(out.filter(F.col("__explicit").isNotNull()).select(F.col(subject).alias("__s"), "__explicit"), "__s", "__explicit")
    out = out.join(votes.select("__s", F.col("__explicit").alias("__voted"), "share", "total"), F.col(subject) == F.col("__s"), "left")
    of_default = F.col("category") == default
    voted = F.when((F.col("share") >= least) & (F.col("total") >= floor), F.col("__voted"))
    lean = rules.first_match(F.lower(F.coalesce(F.col(brand), F.lit(""))), leanings)
    kind = F.when(of_default, F.coalesce("__explicit", voted, lean))
    method = F.when(~of_default, "category").when(F.col("__explicit").isNotNull(), "explicit").when(voted.isNotNull(), "subject").when(lean.isNotNull(), "brand").otherwise("none")
    sure = F.when(method.isin("category", "explicit"), "HIGH").when(method == "subject", confidence(F.col("share"), F.col("total"), F.lit(None))).when(method == "brand", "LOW").otherwise("NONE")
    return out.withColumns({"kind": kind, "method": method, "confidence": sure}).drop("__explicit", "__s", "__voted", "share", "total")


def reason_samples(rows: DataFrame, reasons: Column, key: str, most: int = 10, salts: int = 64) -> DataFrame:
    """(reason, n, samples): how many rows have each reason, and the ``most`` smallest keys, the feature being a short report.

    A frequent reason is ranked within ``salts`` parts first, so that only ``most`` keys of each part meet in one task.
    """
    each = rows.select(F.col(key).alias("k"), F.explode(reasons).alias("reason"))
    parts = each.withColumn("salt", F.pmod(F.xxhash64("k"), F.lit(salts)))
    first = parts.withColumn("r", F.row_number().over(Window.partitionBy("reason", "salt").orderBy("k"))).filter(F.col("r") <= most)
    first = first.withColumn("r", F.row_number().over(Window.partitionBy("reason").orderBy("k"))).filter(F.col("r") <= most)
    return each.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).join(first.groupBy("reason").agg(F.sort_array(F.collect_list("k")).alias("samples")), "reason")
