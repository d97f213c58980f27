"""Slice totals kept up to date by a stream.

The first delivery of an order that succeeded comes out of Spark's aggregation state once.  Each micro-batch of such
orders is summed up by slice before it meets the totals, so a hot slice is one row there, and the new totals of the
slices it touched are a version of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.accumulate import slice_totals
from tallyline.plans.options import JobOptions
from tallyline.sources.definitions import DefinitionSet
from tallyline.streaming.dedupe import output_mode, streaming_updates
from tallyline.streaming.state import COMPACT, SliceState

_KEY = "ref_name string, dimension_key string, granularity string, slice_ts long"
_VALUES = "value double, orders long"


def _state(spark: SparkSession, folder: str, compact: int = COMPACT) -> SliceState:
    return SliceState(spark, folder, _KEY, _VALUES, compact)


def start_slice_totals(
    orders: DataFrame,
    definitions: DefinitionSet,
    folder: str,
    checkpoint: str,
    options: JobOptions = JobOptions(),
    compact: int = COMPACT,
    **trigger,
) -> StreamingQuery:
    """Keep the totals of a stream of orders below ``folder``; a restart goes on from the checkpoint."""

    def add(batch: DataFrame, number: int) -> None:
        state = _state(batch.sparkSession, folder, compact)
        state.forget(number)
        before = state.before(number).select(*state.key, "version", *state.values)
        new = slice_totals(batch).persist()
        try:
            touched = state.latest(before.join(new.select(*state.key), state.key, "left_semi"))
            old = touched.withColumnsRenamed({"value": "old_value", "orders": "old_orders"})
            both = new.join(old, state.key, "left")
            value = F.coalesce("old_value", F.lit(0.0)) + F.col("value")
            count = F.coalesce("old_orders", F.lit(0)) + F.col("orders")
            state.write(both.select(*state.key, value.alias("value"), count.alias("orders")), number)
        finally:
            new.unpersist()

    updates = streaming_updates(orders, definitions, options)
    writer = updates.writeStream.outputMode(output_mode(options)).foreachBatch(add)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_slice_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The totals after the last micro-batch, in the columns of ``slice_totals``."""
    return _state(spark, folder).all()
