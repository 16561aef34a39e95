"""Readers of landed files, all with declared schemas."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def with_lineage(df: DataFrame) -> DataFrame:
    """src_file and src_row: the row's number within the file where the format has one (Parquet), else a number that keeps the order within a file.

    The latter follows from how one scan splits its files, so tell rows apart by it within one scan only, as :func:`..operators.canonical.canonicalize`
    does, or land the rows as Parquet first.
    """
    meta = df.metadataColumn("_metadata")
    row = meta["row_index"] if "row_index" in df.select(meta.alias("m")).schema["m"].dataType.names else F.monotonically_increasing_id()
    return df.select("*", meta["file_path"].alias("src_file"), row.alias("src_row"))


def read_json(spark: SparkSession, path: str | list[str], columns: Sequence[str], lines: bool | None = None) -> DataFrame:
    """Arrays of objects, or one object per line for ``.jsonl``; columns as text, missing ones null, bad lines all null."""
    first = path if isinstance(path, str) else path[0]
    lines = first.endswith((".jsonl", ".ndjson")) if lines is None else lines
    return with_lineage(spark.read.schema(text_schema(columns)).option("multiLine", not lines).json(path))


def read_nested(spark: SparkSession, path: str, schema: str, needed: str) -> DataFrame:
    """Lines with nested objects; rows without ``needed`` (bad lines too) go, :func:`nested_counts` counts them."""
    return with_lineage(spark.read.schema(schema).json(path)).filter(F.col(needed).isNotNull())


def nested_counts(spark: SparkSession, path: str, schema: str, needed: str) -> DataFrame:
    """One row (n_seen, n_kept, n_without, n_broken) of what :func:`read_nested` makes of the lines of ``path``."""
    rows = spark.read.schema(f"{schema}, __broken string").option("columnNameOfCorruptRecord", "__broken").json(path)
    kept, broken = F.col(needed).isNotNull(), F.col("__broken").isNotNull()
    return rows.select(kept.alias("k"), broken.alias("b")).agg(
        F.count(F.lit(1)).alias("n_seen"), F.count_if("k").alias("n_kept"), F.count_if(~F.col("k") & ~F.col("b")).alias("n_without"), F.count_if(~F.col("k") & F.col("b")).alias("n_broken")
    )


def read_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet files by name, united by name; folders called ``key=value`` give no columns."""
    parts = [spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(p) for p in paths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def seed(spark: SparkSession, path: str, field: str, schema: str) -> DataFrame:
    """The records of a small JSON document's array ``field``."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"struct<`{field}`:array<struct<{schema}>>>")[field]).alias("r")).select("r.*")


def read_lake(spark: SparkSession, base: str, *paths: str) -> DataFrame:
    """Partitioned Parquet, united by name."""
    return spark.read.option("mergeSchema", True).option("basePath", base).parquet(*(paths or (base,)))


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], header: bool) -> DataFrame:
    return spark.read.schema(text_schema(columns)).option("header", header).csv(path)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """RSS items: title, link, pubDate, category (array)."""
    schema = "title string, link string, pubDate string, category array<string>"
    return spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)


def read_after(table: DataFrame, at: str, mark: Column) -> DataFrame:
    """Rows from the high-water mark on, null ones first: the boundary is read again, later steps drop what is known."""
    return table.filter(F.col(at).isNull() | (F.col(at) >= mark)).orderBy(F.col(at).asc_nulls_first())


def read_checked_list(spark: SparkSession, path: str, magic: str) -> DataFrame:
    """(source, key) of a list that starts with ``magic`` and ends with ``# end count=N``; anything else is refused whole."""
    lines = spark.read.text(path, wholetext=True).select(F.filter(F.split("value", "\n"), lambda x: x != "").alias("l"))
    keys = F.filter("l", lambda x: ~x.startswith("#") & (x != magic))
    ends = F.regexp_extract(F.try_element_at("l", F.lit(-1)), r"^# end count=([0-9]+)$", 1).try_cast("int")
    row = lines.select((F.try_element_at("l", F.lit(1)) == magic).alias("a"), (ends == F.size(keys)).alias("b"), keys.alias("k"))
    if row.filter("NOT coalesce(a AND b, false)").limit(1).count():
        raise ValueError(f"{path}: not a whole list")
    return row.select(F.explode("k").alias("k")).select(F.split_part("k", F.lit("/"), F.lit(1)).alias("source"), F.regexp_replace("k", "^[^/]*/", "").alias("key"))


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every link of every page in order: position, target, text without tags."""
    hrefs = F.regexp_extract_all(html, F.lit(r'<a [^>]*href="([^"]*)"[^>]*>'), F.lit(1))
    texts = F.regexp_extract_all(html, F.lit(r'<a [^>]*href="[^"]*"[^>]*>([^<]*)<'), F.lit(1))
    return pages.select("*", F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("label"))).alias("pos", "link")).select(*[c for c in pages.columns if c != html], "pos", "link.href", "link.label")


def lots(pages: DataFrame, html: str = "html") -> DataFrame:
    """``Lot N - $X`` entries of archive pages: lot, price text."""
    found = F.regexp_extract_all(html, F.lit(r"Lot\s+([0-9]+)\s*-\s*(\$[0-9,.]+)"), F.lit(0))
    each = pages.select("*", F.explode(found).alias("__l"))
    return each.select(*[c for c in pages.columns if c != html], F.regexp_extract("__l", r"Lot\s+([0-9]+)", 1).cast("int").alias("lot"), F.regexp_extract("__l", r"\$[0-9,.]+", 0).alias("price_text"))


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and change time of files, without reading them."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def read_table(spark: SparkSession, url: str, table: str, key: str | None = None, parts: int = 8, fetch: int = 10_000, most: int | None = None, **options: str) -> DataFrame:
    """A database table over JDBC; with a numeric ``key`` (spelled as the database does), ``parts`` ranges between its ends are read side by side (null keys are in the first).

    Filters and chosen columns reach the database. A partitioned read is the counterpart of paging by key: no page depends on the one before. ``most`` caps
    the rows of a canary read; ``options`` are the source's, such as queryTimeout (seconds) or sessionInitStatement (to read only).
    """
    if most is not None:
        return read_table(spark, url, table, key, parts, fetch, **options).limit(most)
    base = spark.read.format("jdbc").options(url=url, fetchsize=str(fetch), **options)
    if key is None:
        return base.option("dbtable", table).load()
    low, high = base.option("query", f"SELECT min({key}) AS lo, max({key}) AS hi FROM {table}").load().first()
    base = spark.read.format("jdbc").options(url=url, fetchsize=str(fetch), dbtable=table, **options)
    if low is None:
        return base.load()
    return base.options(partitionColumn=key, lowerBound=str(low), upperBound=str(high + 1), numPartitions=str(parts)).load()


def payload_records(rows: DataFrame, text: str, path: Sequence[str], record: str) -> DataFrame:
    """One row per record of the array at ``path`` in a JSON text, with the fields of ``record`` (a schema) after the other columns.

    Texts that aren't JSON, or lack the path, give no rows. Record fields must not bear names of other columns.
    """
    schema = f"array<struct<{record}>>"
    for name in reversed(path):
        schema = f"struct<`{name}`:{schema}>"
    found = F.from_json(text, schema)
    for name in path:
        found = found[name]
    kept = [c for c in rows.columns if c != text]
    return rows.select(*kept, F.explode(found).alias("__r")).select(*kept, "__r.*")


def urls_in(rows: DataFrame, text: str) -> DataFrame:
    """Every http(s) address in a text, in order: the other columns, pos, url."""
    kept = [c for c in rows.columns if c != text]
    return rows.select(*kept, F.posexplode(F.regexp_extract_all(text, F.lit("https?://[^\\s,\"'<>]+"), F.lit(0))).alias("pos", "url"))


def read_newest_good(spark: SparkSession, base: str, good: Callable[[DataFrame], bool] = lambda df: True) -> tuple[DataFrame, str]:
    """(table, version) of the newest complete version that can be read and passes ``good``; see :func:`writers.publish_version`.

    A version that is half-written, unreadable or refused is passed over, so the last good one stays in force.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted((f.getPath().getName() for f in fs.listStatus(root) if f.isDirectory()), reverse=True) if fs.exists(root) else []
    for name in names:
        if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}/_SUCCESS")):
            try:
                df = spark.read.parquet(f"{base}/{name}")
                if good(df):
                    return df, name
            except (PySparkException, Py4JJavaError):
                continue
    raise ValueError(f"{base}: no good version")
