"""Micro-batches into the lake, stateful deduplication, and a tail of growing JSON-lines files."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from ..operators.canonical import new_rows


def append_new(stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str], order: Sequence[Column]) -> StreamingQuery:
    """Append rows whose key the table lacks. A batch that is run again writes the same folder again, so each lands once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
        fs = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fresh = batch
        others = [str(f.getPath()) for f in fs.listStatus(done)] if fs.exists(done) else []
        others = [p for p in others if "/batch-" in p and not p.endswith(f"/batch-{batch_id}")]
        if others:
            index = spark.read.parquet(*others).select(*keys)
            fresh = new_rows(batch, index, keys, order)
        else:
            fresh = new_rows(batch, batch.limit(0).select(*keys), keys, order)
        fresh.write.mode("overwrite").parquet(f"{table}/batch-{batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_appended(spark, table: str) -> DataFrame:
    return spark.read.parquet(f"{table}/batch-*")


def dedup_stream(stream: DataFrame, keys: Sequence[str], at: str | None = None, late: str | None = None) -> DataFrame:
    """First row per key: over all time, or within the watermark that bounds the state.

    Start it within :func:`.state.disk_state`, since state over all time grows with the keys.
    """
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys)) if at and late else stream.dropDuplicates(list(keys))


def unseen_items(items: DataFrame, link: str, at: str, mark: Column, seen: DataFrame) -> DataFrame:
    """Feed items that are neither among the ``seen`` links (``link``) nor at or before the mark; an item without a time counts as after it."""
    s = seen.select(F.col(link).alias("__seen"))
    return items.join(s, F.col(link) == F.col("__seen"), "left_anti").filter(mark.isNull() | F.col(at).isNull() | (F.col(at) > mark))


def seen_ring(before: DataFrame, items: DataFrame, link: str, at: str, most: int = 500) -> DataFrame:
    """(link, at) of the ``most`` latest links, old and new: the ring that the next read of the feed is checked against."""
    every = before.select(link, at).unionByName(items.select(link, at)).groupBy(link).agg(F.max(at).alias(at))
    return every.orderBy(F.col(at).desc_nulls_last(), link).limit(most)


def after_marks(rows: DataFrame, marks: DataFrame, key: str, at: str) -> DataFrame:
    """Rows newer than their key's high-water mark; keys without one pass."""
    m = marks.select(F.col(key).alias("__k"), F.col("mark").alias("__m"))
    return rows.join(m, F.col(key) == F.col("__k"), "left").filter(F.col("__m").isNull() | (F.col(at) > F.col("__m"))).drop("__k", "__m")


class _TailReader(SimpleDataSourceStreamReader):
    def __init__(self, path: str, most: int, keep_bad: bool = False):
        self.path, self.most, self.keep_bad = path, most, keep_bad

    def initialOffset(self) -> dict:
        return {"at": 0}

    def _whole_lines(self, start: int, end: int | None) -> bytes:
        """Lines from ``start`` on: up to ``end``, or about ``most`` bytes and at least one line, however long; an unfinished line waits."""
        with open(self.path, "rb") as f:
            f.seek(start)
            if end is not None:
                return f.read(end - start)
            data = f.read(self.most)
            at = data.rfind(b"\n")
            while at < 0 and (more := f.read(self.most)):
                found = more.find(b"\n")
                at = len(data) + found if found >= 0 else -1
                data += more
            return data[: at + 1]

    def _lines(self, start: int, end: int | None) -> tuple[list[tuple], int]:
        size = os.path.getsize(self.path) if os.path.exists(self.path) else 0
        start = 0 if size < start else start  # the file was replaced
        whole = self._whole_lines(start, end)
        rows: list[tuple] = []
        for line in whole.split(b"\n")[:-1]:
            try:
                good = json.dumps(json.loads(line))
            except ValueError:
                if self.keep_bad and line.strip():
                    rows.append((None, line.decode("utf-8", "replace")))
                continue
            rows.append((good, None) if self.keep_bad else (good,))
        return rows, start + len(whole)

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if not os.path.exists(self.path):
            return iter(()), start
        rows, end = self._lines(start["at"], None)
        return iter(rows), {"at": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._lines(start["at"], end["at"])[0])


class JsonTail(DataSource):
    """``spark.readStream.format("json_tail").load(path)``: whole lines of one growing file on the driver's disk, as JSON text.

    Lines that aren't JSON are left out, or with the option ``keepBad`` come in a second column ``bad``, for a count or a table of
    their own. ``maxBytes`` (64 MB) is what one read takes, or one line if that is longer. Landed immutable files should go through Spark's
    own file source; this is for a file that another process still appends to.
    """

    @classmethod
    def name(cls) -> str:
        return "json_tail"

    def _keeps_bad(self) -> bool:
        return self.options.get("keepBad", "false").lower() == "true"

    def schema(self) -> str:
        return "value string, bad string" if self._keeps_bad() else "value string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _TailReader(self.options["path"], int(self.options.get("maxBytes", 64 << 20)), self._keeps_bad())
