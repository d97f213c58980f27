"""Sliding-window values over slice totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.functions import slices
from tallyline.sources.definitions import DefinitionSet

#: A slice's place in windows of its indicator: its number over the window's length, to 12 digits.
_PLACE = "decimal(32,12)"
#: Just under one window: more than any window of 2^31 slices or less reaches back, less than the next slice.
_REACH = "0.999999999767"


def _with_windows(totals: DataFrame, definitions: DefinitionSet) -> DataFrame:
    """Slice totals with the width and window that belong to their slices.

    A slice's width is its granularity.  The window is that of the first definition with this name and granularity:
    definitions that share a name keep their own.
    """
    granularity = slices.granularity_name(F.col("slice_seconds"))
    named = definitions.table.select("ref_name", granularity.alias("granularity"), "def_ord", "slice_seconds", "window_slices")
    table = named.groupBy("ref_name", "granularity").agg(
        F.min_by("slice_seconds", "def_ord").alias("slice_seconds"),
        F.greatest(F.lit(1), F.min_by("window_slices", "def_ord")).alias("window_slices"),
    )
    # Beyond the size bound Spark picks the join; slice totals are already reduced.
    return totals.join(F.broadcast(table) if definitions.small else table, ["ref_name", "granularity"])


def window_bounds(now_second: Column) -> tuple[Column, Column]:
    """First and last slice start that count at ``now_second``."""
    step = F.col("slice_seconds")
    last = slices.slice_start_at(now_second, step)
    return last - (F.col("window_slices") - 1) * step, last


def value_at(totals: DataFrame, definitions: DefinitionSet, now_second: int, keep_empty: bool = True) -> DataFrame:
    """Window value of every indicator and key at one moment.

    A key whose slices have all aged out reads 0.0, or is left out with ``keep_empty=False``,
    which lets the time bound filter slices before they are grouped.  Where definitions of several granularities share
    a name, each order counts under one of them, and the value is the sum of their windows.
    """
    rows = _with_windows(totals, definitions)
    first, last = window_bounds(F.lit(now_second).cast("bigint"))
    inside = F.col("slice_ts").between(first, last)
    if not keep_empty:
        rows = rows.where(inside)
    value = F.sum(F.when(inside, F.col("value")).otherwise(F.lit(0.0)))
    return rows.groupBy("ref_name", "dimension_key").agg(value.alias("window_value"))


def value_at_every_slice(totals: DataFrame, definitions: DefinitionSet) -> DataFrame:
    """Window value of every slice, taken at that slice.

    Slice numbers are divided by the window's length, so that every window is one long whatever its definition: one
    window expression reads the totals once for any mix of lengths.
    """
    number = F.call_function("div", F.col("slice_ts"), F.col("slice_seconds")).cast("decimal(20,0)")
    place = (number / F.col("window_slices").cast("decimal(11,0)")).cast(_PLACE)
    rows = _with_windows(totals, definitions).withColumn("place", place)
    value = F.expr(
        "sum(value) OVER (PARTITION BY ref_name, dimension_key, granularity ORDER BY place"
        f" RANGE BETWEEN CAST({_REACH} AS {_PLACE}) PRECEDING AND CURRENT ROW)"
    )
    return rows.select("ref_name", "dimension_key", "granularity", "slice_ts", value.alias("window_value"))


def retained(updates: DataFrame, now_second: int) -> DataFrame:
    """Slices a store still holds: those whose retention, counted from the slice start, has not passed."""
    return updates.where(F.col("slice_ts") + F.col("ttl_seconds") > F.lit(now_second))
