"""Writers: partitioned lake tables, snapshots, chunks, deltas, reports."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import staging
from ..operators import ordered


def write_lake(df: DataFrame, path: str, mode: str = "append", row_group: int | None = None) -> None:
    """Parquet by year and month; the shuffle on those keeps each partition to few files, AQE splits large ones. ``row_group``: its bytes."""
    parted = df.withColumns({"year": F.coalesce(F.year("sold_date"), F.lit(0)), "month": F.coalesce(F.month("sold_date"), F.lit(0))})
    out = parted.hint("rebalance", "year", "month").write.mode(mode).option("compression", "zstd").partitionBy("year", "month")
    (out.option("parquet.block.size", row_group) if row_group else out).parquet(path)


def replace_source(df: DataFrame, base: str, source: str) -> None:
    """Replace all of one source's folder, months that are gone too; the source is the folder's name, not a column."""
    write_lake(df.drop("source"), f"{base}/source={source}", "overwrite")


def write_chunks(df: DataFrame, path: str, rows: int = 10_000) -> None:
    df.write.option("maxRecordsPerFile", rows).json(path)


def write_delta_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", False).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small aggregate as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def nested_chunks(cards: DataFrame, sales: DataFrame, key: str, per_chunk: int = 900) -> DataFrame:
    """(chunk, json) of cards with their sales nested, ``per_chunk`` cards each in order of ``key`` (unique), the last chunk the rest."""
    nested = sales.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*[c for c in sales.columns if c != key]))).alias("sales"))
    placed = ordered.ranged_running(cards, [F.col(key)], {"__nth": F.lit(1)}, "chunk-order")
    whole = placed.join(nested, key, "left")
    fields = [F.col(c) for c in (*cards.columns, "sales")]
    return whole.select(F.floor((F.col("__nth") - 1) / per_chunk).alias("chunk"), F.to_json(F.struct(*fields)).alias("json"))


def append_lake(df: DataFrame, path: str, run: str) -> None:
    """Append one run's rows to a lake by year and month, each row marked with the run; a run that is already there isn't added again."""
    spark = df.sparkSession
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_runs/{run}")
    fs = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(mark):
        return
    write_lake(df.withColumn("ingest_run_id", F.lit(run)), path)
    fs.create(mark).close()


@contextmanager
def single_writer(spark: SparkSession, path: str) -> Iterator[None]:
    """Hold ``path``/_writer while the block runs; whoever finds it there is refused. A crash leaves it, with its holder's name in it, to be removed."""
    lock = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_writer")
    fs = lock.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        held = fs.create(lock, False)  # fails if it exists
    except Py4JJavaError as e:
        raise RuntimeError(f"{path} has a writer") from e
    held.write(bytearray(spark.sparkContext.applicationId.encode()))
    held.close()
    try:
        yield
    finally:
        fs.delete(lock, False)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace a table whole: written beside it, then renamed, so readers see the old one or the new one."""
    spark = df.sparkSession
    new, old = f"{path}.new", f"{path}.old"
    staging.delete(spark, [new, old])
    df.write.option("compression", "zstd").parquet(new)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hadoop(path)):
        fs.rename(hadoop(path), hadoop(old))
    fs.rename(hadoop(new), hadoop(path))
    staging.delete(spark, [old])


def write_markdown(df: DataFrame, path: str, title: str) -> None:
    """A small aggregate as a Markdown table, one line a row in the order of ``df``."""
    cell = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
    head = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    body = df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in df.columns]), F.lit(" |")).alias("value"))
    _write_text([df.sparkSession.createDataFrame([(x,) for x in head], "value string").coalesce(1), body], path)


def _write_text(parts: list[DataFrame], path: str) -> None:
    """Lines of small tables, one after the other in their own order, as one file."""
    out = None
    for i, part in enumerate(parts):
        p = part.select(F.lit(i).alias("part"), F.monotonically_increasing_id().alias("nth"), "value")
        out = p if out is None else out.unionByName(p)
    if out is not None:
        out.coalesce(1).sortWithinPartitions("part", "nth").select("value").write.mode("overwrite").text(path)


def write_html(df: DataFrame, path: str, title: str) -> None:
    """A small aggregate as one HTML page with a table, one row a line in the order of ``df``."""

    def safe(c: Column) -> Column:
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            c = F.replace(c, F.lit(char), F.lit(entity))
        return c

    cell = lambda c: F.concat(F.lit("<td>"), safe(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>"))
    spark = df.sparkSession
    names = F.array_join(F.transform("c", lambda x: F.concat(F.lit("<th>"), safe(x), F.lit("</th>"))), "")
    top = F.concat(F.lit('<!doctype html><meta charset="utf-8"><title>'), safe(F.col("t")), F.lit("</title><table><tr>"), names, F.lit("</tr>"))
    head = spark.createDataFrame([(title, list(df.columns))], "t string, c array<string>").select(top.alias("value"))
    body = df.select(F.concat(F.lit("<tr>"), *[cell(c) for c in df.columns], F.lit("</tr>")).alias("value"))
    _write_text([head, body, spark.createDataFrame([("</table>",)], "value string")], path)


def append_run(df: DataFrame, path: str, run: str) -> None:
    """Add one run's rows under its own folder; the same run again replaces only itself."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/ingest_run_id={run}")


def publish_version(df: DataFrame, base: str, version: int) -> str:
    """Write a whole version beside the earlier ones; readers take the newest good one."""
    path = f"{base}/v{version:010d}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def write_dated_report(df: DataFrame, base: str, day: str) -> None:
    """A small aggregate under its day, and again as ``latest``."""
    for name in (day, "latest"):
        write_report(df, f"{base}/{name}")
