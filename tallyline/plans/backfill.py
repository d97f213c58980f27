"""The batch form of the job: a static feed to slice updates, rejects and dead letters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyline.operators.accumulate import counted_orders, describe, slice_updates
from tallyline.operators.evaluate import failed_scripts, route_and_evaluate
from tallyline.operators.parse import dead_letters, field_schema, good_orders, parse_messages
from tallyline.session import prepare
from tallyline.sources.definitions import DefinitionSet


@dataclass(frozen=True)
class Backfill:
    """The outputs of one batch run; each is computed only when used."""

    updates: DataFrame
    script_rejects: DataFrame
    dead_letters: DataFrame | None = None


def backfill_orders(orders: DataFrame, definitions: DefinitionSet) -> Backfill:
    """Slice updates for typed orders: one row per order and indicator that counted it."""
    updates = slice_updates(describe(counted_orders(orders, definitions), definitions))
    return Backfill(updates, failed_scripts(route_and_evaluate(orders, definitions), definitions))


def backfill_messages(messages: DataFrame, definitions: DefinitionSet) -> Backfill:
    """The same from JSON messages, with the refused ones."""
    prepare(messages.sparkSession)
    parsed = parse_messages(messages, field_schema(definitions))
    result = backfill_orders(good_orders(parsed), definitions)
    return Backfill(result.updates, result.script_rejects, dead_letters(parsed))
