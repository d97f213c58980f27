"""Session settings the engine relies on, and the shared folder it may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A repeated key inside a nested JSON value keeps its last value instead of failing the message.
_DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"
_ANSI = "spark.sql.ansi.enabled"
_CHECKPOINT_DIR = "spark.checkpoint.dir"

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime settings that change results.  Safe to call repeatedly."""
    spark.conf.set(_DUPLICATE_KEYS, "true")
    return spark


def prepare_streaming(spark: SparkSession) -> SparkSession:
    """Settings for queries with state: RocksDB keeps it off the heap and ships only changes."""
    prepare(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


@contextmanager
def null_on_error(spark: SparkSession) -> Iterator[None]:
    """Analyse expressions so that a bad row gives NULL instead of ending the query.

    The mode is stored in each expression when it is analysed, so a DataFrame built
    inside this block keeps it when it runs later under the session's own setting.
    """
    before = spark.conf.get(_ANSI)
    spark.conf.set(_ANSI, "false")
    try:
        yield
    finally:
        spark.conf.set(_ANSI, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``."""
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set(_CHECKPOINT_DIR, local)
    return local


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, folder: str):
    """A folder's file system and path, whatever store it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what stands in a folder, in order; none if there is no such folder."""
    store, path = _path(spark, folder)
    return sorted(entry.getPath().getName() for entry in store.listStatus(path)) if store.exists(path) else []


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder that the engine made."""
    store, path = _path(spark, folder)
    store.delete(path, True)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there."""
    folder = new_run_dir(frame.sparkSession, name)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
