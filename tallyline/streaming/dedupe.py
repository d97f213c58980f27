"""First-success de-duplication on a stream.

State is keyed by the indicator's name, never by its place in the definition list, so it stays valid
when the job restarts with other definitions.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, functions as F

from tallyline.functions import slices
from tallyline.operators.accumulate import delivery_place, describe, slice_updates
from tallyline.operators.evaluate import route_and_evaluate
from tallyline.plans.options import JobOptions
from tallyline.sources.definitions import DefinitionSet

IDENTITY = ["ref_name", "dimension_key", "order_id"]


def output_mode(options: JobOptions) -> str:
    return "update" if options.dedupe == "first_arrival" else "append"


def streaming_updates(orders: DataFrame, definitions: DefinitionSet, options: JobOptions) -> DataFrame:
    """Slice updates of a stream of orders; write them in ``output_mode(options)``."""
    evaluated = route_and_evaluate(orders, definitions)
    if options.dedupe == "any" and definitions.repeated_refs:
        warnings.warn("indicators share a name: with dedupe='any' either may count an order", stacklevel=2)
    good = describe(evaluated.where(F.col("increment").isNotNull()), definitions)
    return updates_of_increments(good, options)


def updates_of_increments(increments: DataFrame, options: JobOptions) -> DataFrame:
    """The slice updates of deliveries that count, from what each delivery would add."""
    facts = ("slice_seconds", "window_slices")
    if options.dedupe == "first_arrival":
        # numbers only, so that the aggregation stays a hash aggregation; a slice's width has one name
        winners = first_arrival(increments.withColumn("place", delivery_place()), facts)
        winners = winners.withColumn("granularity", slices.granularity_name(F.col("slice_seconds")))
    else:
        winners = _any_delivery(increments, options, ("granularity", *facts))
    return slice_updates(winners.withColumn("slice_granularity", F.col("granularity")))


def first_arrival(good: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The earliest delivery, reduced before the shuffle and kept in aggregation state.

    An identity belongs to this micro-batch when the batch that first saw it is the one that
    sees it now; redeliveries in later batches leave it unequal and emit nothing.
    """
    kept = ("def_ord", "arrival_seq", "slice_ts", "increment", *carry)
    stamped = good.select(*IDENTITY, *kept, "place", F.unix_millis(F.current_timestamp()).alias("batch"))
    first = stamped.groupBy(*IDENTITY).agg(
        *[F.min_by(c, "place").alias(c) for c in kept],
        F.min("batch").alias("first_seen"),
        F.max("batch").alias("last_seen"),
    )
    return first.where(F.col("first_seen") == F.col("last_seen")).select(*IDENTITY, *kept)


def _any_delivery(increments: DataFrame, options: JobOptions, facts: tuple[str, ...]) -> DataFrame:
    narrow = increments.select(*IDENTITY, "slice_ts", "increment", "event_epoch_ms", *facts)
    if options.forget_after:
        timed = narrow.withColumn("event_time", F.timestamp_millis("event_epoch_ms"))
        return timed.withWatermark("event_time", options.forget_after).dropDuplicatesWithinWatermark(IDENTITY)
    return narrow.dropDuplicates(IDENTITY)
