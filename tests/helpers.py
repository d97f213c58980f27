"""Small builders and a plain model of the rules, for tests only."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators.parse import field_schema, good_orders, parse_messages
from tallyline.session import prepare
from tallyline.sources.definitions import DefinitionSet

HOUR = 3600


def message(order_id, code="E", at=1, /, **fields) -> str:
    return json.dumps({"orderId": order_id, "eventTypeCode": code, "eventEpochMs": at, "fields": fields})


def definitions(spark: SparkSession, *rows: dict) -> DefinitionSet:
    return DefinitionSet.of_rows(prepare(spark), rows)


def messages(spark: SparkSession, texts: Iterable[str | None]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(texts)), "arrival_seq long, value string").coalesce(1)


def orders(spark: SparkSession, known: DefinitionSet, texts: Iterable[str]) -> DataFrame:
    return good_orders(parse_messages(messages(spark, texts), field_schema(known)))


def rows(frame: DataFrame, *columns: str) -> list[tuple]:
    return sorted(tuple(r) for r in frame.select(*columns).collect())
