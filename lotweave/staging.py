"""Tables in the folder that driver and executors share, and joins whose broadcast follows a count."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_made: list[str] = []
_local: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster its absence is an error, since
    a folder of one machine would hide files from the others.
    """
    global _local
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local is None:
        _local = tempfile.mkdtemp(prefix="lotweave-shared-")
        atexit.register(shutil.rmtree, _local, True)
    return "file://" + _local


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/lotweave/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, paths: list[str]) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete every table that :func:`staged` wrote; call it once results that read them are stored."""
    delete(spark, _made)
    _made.clear()


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths made within the block, for a later :func:`delete`; :func:`release` no longer knows them."""
    before = len(_made)
    mine: list[str] = []
    try:
        yield mine
    finally:
        mine += _made[before:]
        del _made[before:]


def tidy(spark: SparkSession) -> None:
    """Let Spark drop the broadcasts and shuffle files of results that nothing refers to any more.

    Its cleaner acts on what the driver's collector finds, which by itself may not run for half an hour; until then executors hold them all.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_enough(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if counting shows at most ``max_rows`` rows, else as it is (a shuffled join)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def small_or_merged(df: DataFrame, max_rows: int, counted: DataFrame | None = None) -> DataFrame:
    """As :func:`small_enough`, but the shuffled join is a merge: else Spark may send either side to the driver whose files merely pack well.

    ``counted`` is a table with as many rows that is cheaper to count.
    """
    few = (df if counted is None else counted).limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df.hint("merge")


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores put before it until no column of ``taken`` is called that (in any case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name
