"""Column layouts that cross module borders."""

from __future__ import annotations

from pyspark.sql import types as T

#: A normalised indicator definition.
DEFINITION = T.StructType(
    [
        T.StructField("def_ord", T.LongType(), False),
        T.StructField("ref_name", T.StringType(), False),
        T.StructField("event_type_codes", T.ArrayType(T.StringType()), False),
        T.StructField("dimensions", T.ArrayType(T.StringType()), False),
        T.StructField("slice_seconds", T.LongType(), False),
        T.StructField("window_slices", T.IntegerType(), False),
        T.StructField("slice_granularity", T.StringType(), False),
        T.StructField("acc_script", T.StringType(), False),
        T.StructField("field_types", T.MapType(T.StringType(), T.StringType()), False),
    ]
)

#: One event per (order, indicator): what the order adds to one slice.
SLICE_UPDATE = T.StructType(
    [
        T.StructField("ref_name", T.StringType()),
        T.StructField("dimension_key", T.StringType()),
        T.StructField("granularity", T.StringType()),
        T.StructField("slice_ts", T.LongType()),
        T.StructField("increment", T.DoubleType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("slice_key", T.StringType()),
        T.StructField("ttl_seconds", T.LongType()),
    ]
)

#: What one delivery of an order would add, before it is known whether it counts.
INCREMENT = T.StructType(
    [
        *SLICE_UPDATE.fields[:6],
        T.StructField("slice_seconds", T.LongType()),
        T.StructField("window_slices", T.IntegerType()),
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("def_ord", T.LongType()),
        T.StructField("event_epoch_ms", T.LongType()),
    ]
)

#: How often something happened in a micro-batch, under a version of the definitions.
COUNTER = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField("version", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)

# Property names of an order message.
ORDER_ID = "orderId"
EVENT_TYPE_CODE = "eventTypeCode"
EVENT_EPOCH_MS = "eventEpochMs"
FIELDS = "fields"
ORDER_PROPERTIES = (ORDER_ID, EVENT_TYPE_CODE, EVENT_EPOCH_MS, FIELDS)

# Property names of a slice update on the wire, by column.
UPDATE_PROPERTIES = {
    "ref_name": "refName",
    "dimension_key": "dimensionKey",
    "granularity": "granularity",
    "slice_ts": "sliceTs",
    "increment": "increment",
    "order_id": "orderId",
    "slice_key": "sliceKey",
    "ttl_seconds": "ttlSeconds",
}
