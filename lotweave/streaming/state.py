"""State on disk for stateful streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: RocksDB keeps state on local disk with bounded memory and its change log in the checkpoint.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Else each state partition allocates several MB of log and manifest in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


@contextmanager
def disk_state(spark: SparkSession, **more: str) -> Iterator[None]:
    """Streams started within the block keep their state in RocksDB; the session's settings come back after it.

    ``more`` holds further settings, dots written as double underscores.
    """
    settings = ROCKSDB | {k.replace("__", "."): v for k, v in more.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
