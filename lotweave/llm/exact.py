"""Exact deduplication through a stateful stream.

The table is read as a stream of files. For each digest of the normalised text the state store (RocksDB, on disk, with
no watermark and so no expiry) retains the smallest identifier, the locator of that row (file and row number) and the
number of rows. The state is then read as a table: a row that hits a digest of another row has its full normalised bytes
compared with the row at the locator, and rows that differ in bytes despite the digest form groups by their whole text.
Rows of a digest with many copies are salted, so no task gets them all.

Texts of any length go through whole; only those of rows with a hit are shuffled. Nulls: a null text is the empty text; a null
id comes after every other id. Rows with the same id and text: the one at the smallest locator stays. An empty table gives an
empty result. Other columns than the two read are kept by :func:`kept_rows`, whatever they are called, and else ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: Buckets of the digests that are hit; so many rows of two longs are broadcast at most.
SIEVE = 2**20
#: Rows of one digest that share a salt on average.
ROWS_PER_SALT = 64
STATE_BYTES = 16 << 20
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # The stream runs once, so executors needn't keep each state partition open.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # Else each state partition allocates several MB of log and manifest in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normal(col: str) -> Column:
    """The text with each run of separators as one space; null as empty."""
    return F.regexp_replace(F.coalesce(F.col(col), F.lit("")), shared.GAP, " ")


def digest(col: str) -> Column:
    return F.sha2(normal(col), 256)


def _place(table: DataFrame) -> list[Column]:
    """File and row number, also of a table that has a column ``_metadata`` itself."""
    meta = table.metadataColumn("_metadata")
    return [meta["file_path"].alias("file"), meta["row_index"].alias("row")]


def _row(table: DataFrame, id_col: str, text_col: str, digest_of) -> list[Column]:
    return [
        F.col(id_col).alias("id"),
        F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), *_place(table)).alias("at"),
        digest_of(text_col).alias("digest"),
    ]


def _stream_path(spark: SparkSession, path: str) -> str:
    """A stream takes a single file only as a glob."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    single = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isFile()
    return f"{path[:-1]}[{path[-1]}]" if single else path


def _state_parts(spark: SparkSession, path: str) -> int:
    """Partitions of the state: one for each STATE_BYTES of input, between the cluster's cores and the session's shuffle partitions.

    Every partition is a RocksDB instance with memory of its own, so a small table shouldn't get as many as a large one.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, max(spark.sparkContext.defaultParallelism, -(-size // STATE_BYTES))))


def keyed_state(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest_of=digest, files_per_batch: int | None = None) -> DataFrame:
    """(digest, at, n) of every row of the Parquet table at ``path``, as the stream's state retains them."""
    settings = STATE | {"spark.sql.shuffle.partitions": str(_state_parts(spark, path))}
    before = {k: spark.conf.get(k, None) for k in settings}
    checkpoint = shared.new_path(spark, "exact-state")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        stream = spark.readStream.schema(spark.read.parquet(path).schema)
        stream = stream.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else stream
        stream = stream.parquet(_stream_path(spark, path))
        rows = stream.select(*_row(stream, id_col, text_col, digest_of))
        state = rows.groupBy("digest").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("n"))
        query = state.writeStream.format("noop").outputMode("update").trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    kept = spark.read.format("statestore").load(checkpoint)
    value = kept.schema["value"].dataType.names
    return kept.select(F.col("key.digest").alias("digest"), F.col(f"value.`{value[0]}`").alias("at"), F.col(f"value.`{value[1]}`").alias("n"))


def dedup_exact(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest_of=digest, files_per_batch: int | None = None) -> DataFrame:
    """One row per row of the table at ``path``: id, at (its locator), keep (the locator of the row that stays), group_size, kept, digest.

    ``digest_of`` maps the text column's name to a digest; a weak one only makes more rows go through the comparison of bytes.
    """
    state = keyed_state(spark, path, id_col, text_col, digest_of, files_per_batch)
    hits = shared.staged(state.filter("n > 1").select("digest", F.col("at").alias("keep"), "n"), "exact-hits")

    # Digests with many rows are spread over several salts. The sieve has the salts of each bucket of hit digests, so it is broadcast
    # whatever the table's size, and it also tells rows without a hit, whose texts go no further.
    bucket = F.pmod(F.xxhash64("digest"), F.lit(SIEVE)).alias("bucket")
    sieve = F.broadcast(hits.groupBy(bucket).agg(F.max(F.ceil(F.col("n") / ROWS_PER_SALT)).alias("salts")))
    table = spark.read.parquet(path)
    rows = table.select(*_row(table, id_col, text_col, digest_of), normal(text_col).alias("text"))
    rows = rows.withColumn("bucket", bucket).join(sieve, "bucket", "left")
    salt = F.pmod(F.xxhash64("at"), F.col("salts"))
    rows = shared.staged(rows.select("id", "at", "digest", "salts", salt.alias("salt"), F.when(F.col("salts").isNotNull(), F.col("text")).alias("text")), "exact-rows")
    spread = hits.withColumn("bucket", bucket).join(sieve, "bucket").select("digest", "keep", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))

    known = rows.select("id", "at", "digest", "salt").join(spread, ["digest", "salt"], "left").drop("salt")
    out = known.withColumn("keep", F.coalesce("keep", "at")).withColumn("n", F.coalesce("n", F.lit(1).cast("long")))

    # Full bytes of every hit against the row its digest retains, which goes to each of the digest's salts once.
    texts = rows.filter("salts IS NOT NULL").join(spread.select("digest", "salt", "keep"), ["digest", "salt"])
    first = texts.filter(F.col("at") == F.col("keep"))
    first = first.select("digest", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.col("text").alias("kept_text"))
    others = texts.filter(F.col("at") != F.col("keep")).select("digest", "salt", "at", "text")
    differ = others.join(first, ["digest", "salt"]).filter(F.col("text") != F.col("kept_text")).select("digest", "at", "text")
    differ = shared.staged(differ, "exact-collisions")
    if differ.isEmpty():
        return _result(out)
    wrong = differ.groupBy("digest", "text").agg(F.min("at").alias("keep2"), F.count(F.lit(1)).alias("n2"))
    fixed = differ.join(wrong, ["digest", "text"]).select("at", "keep2", "n2")
    lost = differ.groupBy("digest").agg(F.count(F.lit(1)).alias("lost")).withColumnRenamed("digest", "d")
    out = out.join(fixed, "at", "left").join(lost, F.col("digest") == F.col("d"), "left")
    moved = F.col("keep2").isNotNull()
    out = out.withColumn("keep", F.when(moved, F.col("keep2")).otherwise(F.col("keep")))
    out = out.withColumn("n", F.when(moved, F.col("n2")).otherwise(F.col("n") - F.coalesce("lost", F.lit(0))))
    return _result(out)


def _result(rows: DataFrame) -> DataFrame:
    return rows.select("id", "at", "keep", F.col("n").alias("group_size"), (F.col("at") == F.col("keep")).alias("kept"), "digest")


def kept_rows(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """The rows of a Parquet table that stay, with all columns.

    ``path`` is the table's folder. It needn't be given where ``docs`` is a plain scan of one; any other ``docs`` is written to the
    shared folder first.
    """
    path = path or shared.parquet_path(docs)
    if path is None:
        path = shared.new_path(spark, "exact-input")
        docs.write.parquet(path)
    rows = spark.read.schema(docs.schema).parquet(path)
    names = rows.columns
    here, file, row = (shared.fresh(names, n) for n in ("here", "gone_file", "gone_row"))
    gone = dedup_exact(spark, path, id_col, text_col).filter("not kept").select(F.col("at.file").alias(file), F.col("at.row").alias(row))
    gone = shared.staged(gone, "exact-gone")
    rows = rows.select("*", F.struct(*_place(rows)).alias(here))
    left = rows.join(shared.small_enough(gone, 500_000), (F.col(f"{here}.file") == F.col(file)) & (F.col(f"{here}.row") == F.col(row)), "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in names])
