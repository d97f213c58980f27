"""Order messages: JSON text to typed orders, and the reason for every message refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyline import schemas
from tallyline.functions.text import is_blank
from tallyline.sources.definitions import DefinitionSet

# Reasons carried by refused messages.
EMPTY_MESSAGE = "空消息"
NO_ORDER_ID = "缺少 orderId"
UNREADABLE_PREFIX = "反序列化失败: "

_CORRUPT = "_corrupt"
_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def field_schema(definitions: DefinitionSet) -> T.DataType:
    """Only the order fields that some definition reads; all others are skipped while parsing.

    Script inputs keep their JSON type, dimension values are read as text.  Names that differ in case
    only cannot stand side by side in a struct, so then all fields are kept as a map.
    """
    inputs = definitions.input_names
    text_only = [n for n in definitions.dimension_names if n not in inputs]
    if len({n.lower() for n in (*inputs, *text_only)}) < len(inputs) + len(text_only):
        return T.MapType(T.StringType(), T.VariantType())
    return T.StructType(
        [T.StructField(n, T.VariantType()) for n in inputs] + [T.StructField(n, T.StringType()) for n in text_only]
    )


def parse_messages(messages: DataFrame, fields: T.DataType) -> DataFrame:
    """Add the parsed order and ``fail_reason`` to every message in column ``value``.

    Other columns (such as ``arrival_seq``) are kept.  ``fail_reason`` is NULL for a good order.
    """
    schema = T.StructType(
        [
            T.StructField(schemas.ORDER_ID, T.StringType()),
            T.StructField(schemas.EVENT_TYPE_CODE, T.StringType()),
            T.StructField(schemas.EVENT_EPOCH_MS, T.StringType()),
            T.StructField(schemas.FIELDS, fields),
            T.StructField(_CORRUPT, T.StringType()),
        ]
    )
    kept = [c for c in messages.columns if c != "value"]
    read = F.struct(
        F.from_json("value", schema, _JSON_OPTIONS).alias("order"),
        F.json_object_keys("value").alias("properties"),
    )
    # A one-row generator around a lambda: each message is parsed once (its keys are read by a second, shallow pass) and its checks stay with the parser,
    # neither copied into every filter above nor compiled into one method with the join.
    timed = F.transform(
        F.array(read), lambda m: m.withField("millis", _epoch_ms(m["order"][schemas.EVENT_EPOCH_MS]))
    )
    return messages.select(*kept, F.col("value").alias("raw"), F.inline(F.transform(timed, _checked)))


def _checked(message: Column) -> Column:
    order = message["order"]
    order_id, event_type = order[schemas.ORDER_ID], order[schemas.EVENT_TYPE_CODE]
    # Counting is enough for nearly all messages; only a repeated or unknown property needs the comparison.
    properties = message["properties"]
    known = F.array(*[F.lit(p) for p in schemas.ORDER_PROPERTIES])
    present = sum((F.array_contains(properties, p).cast("int") for p in schemas.ORDER_PROPERTIES), F.lit(0))
    unknown = (F.size(properties) > present) & (F.size(F.array_except(properties, known)) > 0)
    unreadable = (
        F.when(order.isNull() | order[_CORRUPT].isNotNull(), F.lit("not an order object"))
        .when(unknown, F.lit("unknown property"))
        .when(_is_nested(order_id, schemas.ORDER_ID), F.lit("orderId is not a scalar"))
        .when(_is_nested(event_type, schemas.EVENT_TYPE_CODE), F.lit("eventTypeCode is not a scalar"))
        .when(message["millis"].isNull(), F.lit("eventEpochMs is not a number"))
    )
    reason = F.when(is_blank(F.col("value")), F.lit(EMPTY_MESSAGE)).otherwise(
        F.coalesce(
            F.concat(F.lit(UNREADABLE_PREFIX), unreadable), F.when(is_blank(order_id), F.lit(NO_ORDER_ID))
        )
    )
    return F.struct(
        order_id.alias("order_id"),
        event_type.alias("event_type_code"),
        message["millis"].alias("event_epoch_ms"),
        order[schemas.FIELDS].alias("fields"),
        reason.alias("fail_reason"),
    )


def _kind(name: str) -> Column:
    """JSON type of one top-level property; evaluated only for the few values that need it."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json("value"), f"$.{name}", "variant"))


def _is_nested(text: Column, name: str) -> Column:
    looks_nested = F.substring(text, 1, 1).isin("{", "[")
    return F.when(looks_nested, _kind(name).rlike("^(OBJECT|ARRAY)")).otherwise(F.lit(False))


def _epoch_ms(text: Column) -> Column:
    """Milliseconds as a long: fractions are cut off, absent counts as 0, NULL means refused.

    Text may hold a whole number only; a JSON number may have a fraction.
    """
    trimmed = F.trim(text)
    is_text = _kind(schemas.EVENT_EPOCH_MS) == "STRING"
    return (
        F.when(text.isNull() | trimmed.isin("", "null"), F.lit(0).cast("bigint"))
        .when(trimmed.rlike(r"^[+-]?[0-9]+$"), trimmed.try_cast("bigint"))
        .when(~is_text, trimmed.try_cast("decimal(38,18)").try_cast("bigint"))
    )


def good_orders(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("fail_reason").isNull()).drop("raw", "fail_reason")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("fail_reason").isNotNull()).select("raw", "fail_reason")
