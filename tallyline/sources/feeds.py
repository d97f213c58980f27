"""Order feeds derived from the sample tables: table rows and JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Arrival numbers of redeliveries start here, after every first delivery.
REDELIVERY_OFFSET = 2**40

#: Order status in the sample table to event type code.
ORDER_EVENTS = {"F": "EVT_FILLED", "O": "EVT_OPEN", "P": "EVT_PENDING"}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(table: DataFrame, key: str) -> DataFrame:
    """A table in fewer splits than there are cores is spread by its key before it fans out.

    A table large enough to keep all cores busy is left as it is scanned.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table if table.rdd.getNumPartitions() >= cores else table.repartition(cores, key)


def epoch_ms(table: DataFrame, column: str) -> Column:
    """Milliseconds since the epoch; a timestamp without zone is read as UTC, whatever the session zone."""
    value = F.col(column)
    if not isinstance(table.schema[column].dataType, T.TimestampNTZType):
        return F.unix_millis(value.cast("timestamp"))
    days = F.unix_date(value.cast("date")).cast("bigint")
    minutes = days * 1440 + F.hour(value) * 60 + F.minute(value)
    return minutes * 60_000 + F.floor(F.extract(F.lit("SECOND"), value) * 1000).cast("bigint")


def event_orders(events: DataFrame) -> DataFrame:
    """Each event as an order, in the column layout that routing takes."""
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("bigint")).select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("event_type").alias("event_type_code"),
        epoch_ms(events, "ts").alias("event_epoch_ms"),
        F.col("event_id").alias("arrival_seq"),
        F.struct(
            F.col("user_id").alias("userId"),
            F.col("value").alias("amount"),
            F.col("k"),
            F.col("event_type").alias("kind"),
            F.when(F.col("k") < 50, F.col("k")).alias("coupon"),
        ).alias("fields"),
    )


def table_orders(orders: DataFrame) -> DataFrame:
    """Each row of the sample order table as an order."""
    code = F.coalesce(*[F.when(F.col("o_orderstatus") == s, F.lit(c)) for s, c in ORDER_EVENTS.items()])
    return orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        code.alias("event_type_code"),
        epoch_ms(orders, "o_orderdate").alias("event_epoch_ms"),
        F.col("o_orderkey").alias("arrival_seq"),
        F.struct(
            F.col("o_custkey").alias("customerId"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_orderpriority").alias("priority"),
        ).alias("fields"),
    )


def redelivered_orders(events: DataFrame) -> DataFrame:
    """Every event twice: the second delivery is an hour later and its amount is one higher.

    Events with ``k`` below 20 carry no amount the first time, so a sum fails on them and
    only their second delivery can count.
    """
    first = event_orders(events)
    fields = F.col("fields")
    first_amount = F.when(fields["k"] >= 20, fields["amount"])
    deliveries = F.array(
        F.struct(F.lit(0).cast("bigint").alias("later"), first_amount.alias("amount")),
        F.struct(F.lit(1).cast("bigint").alias("later"), (fields["amount"] + 1).alias("amount")),
    )
    return first.withColumn("d", F.explode(deliveries)).select(
        "order_id",
        "event_type_code",
        (F.col("event_epoch_ms") + F.col("d.later") * 3_600_000).alias("event_epoch_ms"),
        (F.col("arrival_seq") + F.col("d.later") * REDELIVERY_OFFSET).alias("arrival_seq"),
        fields.withField("amount", F.col("d.amount")).alias("fields"),
    )


def _property(name: str, value: Column, text: bool = False) -> Column:
    shown = F.concat(F.lit('"'), value, F.lit('"')) if text else value
    return F.concat(F.lit(f'"{name}":'), shown)


def event_messages(events: DataFrame) -> DataFrame:
    """Each event as one JSON message; some values of ``k`` stand for some irregularity."""
    order = event_orders(events).select("*", "fields.*")
    identity = F.col("order_id")
    epoch = F.col("event_epoch_ms").cast("string")
    amount = F.col("amount").cast("string")
    user = _property("userId", F.col("userId").cast("string"))
    plain_fields = F.concat(F.lit("{"), user, F.lit(","), _property("amount", amount), F.lit("}"))

    def message(
        order_id: Column | None = _property("orderId", identity, text=True),
        code: Column | None = _property("eventTypeCode", F.col("event_type_code"), text=True),
        millis: Column | None = _property("eventEpochMs", epoch),
        fields: Column = plain_fields,
        more: str | None = None,
    ) -> Column:
        parts = [order_id, code, millis, _property("fields", fields), F.lit(more) if more else None]
        return F.concat(F.lit("{"), F.concat_ws(",", *[p for p in parts if p is not None]), F.lit("}"))

    own_current = F.concat(F.lit("{"), user, F.lit(',"current":5,"amount":'), amount, F.lit("}"))
    text_amount = F.concat(F.lit("{"), user, F.lit(","), _property("amount", amount, text=True), F.lit("}"))
    irregular = {
        0: F.lit(""),
        1: F.lit(" \u3000\t"),
        2: F.lit("{ not json"),
        3: message(order_id=None),
        4: message(more='"channel":"web"'),
        5: message(order_id=F.lit('"orderId":" "')),
        6: message(millis=_property("eventEpochMs", epoch, text=True)),
        7: message(millis=_property("eventEpochMs", F.concat(epoch, F.lit(".9")))),
        8: message(millis=F.lit('"eventEpochMs":"soon"')),
        9: message(millis=None),
        10: message(order_id=_property("orderId", identity)),
        11: message(order_id=F.lit('"orderId":{"id":1}')),
        12: F.concat(message(), F.lit(" and more")),
        13: message(fields=F.lit("null")),
        14: message(fields=F.lit("[1]")),
        15: message(fields=text_amount),
        16: message(fields=own_current),
        17: message(code=None),
        18: F.lit("null"),
        19: message(order_id=F.concat(F.lit('"orderId":"x",'), _property("orderId", identity, text=True))),
        20: message(millis=_property("eventEpochMs", F.concat(epoch, F.lit(".9")), text=True)),
    }
    chosen = None
    for k, text in irregular.items():
        chosen = F.when(F.col("k") == k, text) if chosen is None else chosen.when(F.col("k") == k, text)
    return order.select("arrival_seq", chosen.otherwise(message()).alias("value"))
