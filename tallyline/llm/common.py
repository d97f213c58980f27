"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(frame: DataFrame) -> DataFrame:
    """Compute a frame once into the shared checkpoint folder and go on from there.

    The copy outlives lost executors.  Spark removes it when the frame is no longer used if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    spark = frame.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(f"{shared_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}")
    return frame.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Have Spark remove shuffle and checkpoint files that nothing refers to any more.

    It does so when the driver's JVM collects garbage, which a driver with little to do seldom does by itself.  What a
    plan refers to is let go in a few rounds, and the files go in the background.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def small_batches(spark: SparkSession, most: str = "8m") -> None:
    """Bound the Arrow batches that Python tasks are given: texts are long, and several tasks share a machine."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def give_back() -> None:
    """Return memory that a finished task no longer uses: its Python worker stays and waits for another task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL(None).malloc_trim(0)


def packed(frame: DataFrame, **parts: Column) -> DataFrame:
    """All columns of a frame as one struct ``row`` beside the parts an operator works on.

    Extra columns of any name travel inside ``row`` and cannot clash with an operator's own.
    """
    return frame.select(F.struct("*").alias("row"), *[part.alias(name) for name, part in parts.items()])


def unpacked(frame: DataFrame, names: Iterable[str], **set_to: Column) -> DataFrame:
    """The packed columns again, in order; ``set_to`` replaces columns or appends them."""
    kept = list(names)
    columns = [set_to.get(n, F.col("row")[n]).alias(n) for n in kept]
    return frame.select(*columns, *[c.alias(n) for n, c in set_to.items() if n not in kept])


def text_of(frame: DataFrame, column: str = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def batches(rows: Iterable[tuple], schema: pa.Schema, most_bytes: int = 8 << 20, most_rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded size from row tuples (sizes are read off text, bytes and lists)."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if size >= most_bytes or len(held) >= most_rows:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
