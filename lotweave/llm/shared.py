"""Helpers of the corpus operators: words, batch sizes; tables in the shared folder come from :mod:`lotweave.staging`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import delete, fresh, new_path, recorded, release, shared_dir, small_enough, staged, tidy

__all__ = ["GAP", "WORD", "delete", "fresh", "id_text", "new_path", "parquet_path", "recorded", "release", "shared_dir", "small_batches", "small_enough", "staged", "tidy", "words_of"]

#: A word: a run of anything but space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
#: A run of those separators.
GAP = r"[\x20\x09-\x0D]+"


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 2 << 20) -> None:
    """Lower the session's rows and bytes per Arrow batch: whole texts are handed to Python, and a batch is held on both sides.

    The setting stays, since a plan reads it when it runs, which is after the operator has returned it.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        if not 0 < int(str(spark.conf.get(key)).rstrip("b")) <= most:
            spark.conf.set(key, most)


def parquet_path(df: DataFrame) -> str | None:
    """The folder of a DataFrame that is nothing but a scan of one Parquet table, else None."""
    plan = df._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation" or plan.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return None
    relation = plan.relation()
    roots = relation.location().rootPaths()
    if roots.size() != 1 or relation.fileFormat().getClass().getSimpleName() != "ParquetFileFormat" or relation.partitionSchema().size():
        return None
    return roots.apply(0).toString()


def id_text(col: str) -> Column:
    """An id as text; null becomes the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(col: str) -> Column:
    """Number of words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")
