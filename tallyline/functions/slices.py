"""Slice arithmetic: granularities, slice starts, keys and retention."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyline.functions.text import is_blank, trim_control

# Slice granularities and their widths in seconds.
STEP_SECONDS = {"MINUTE": 60, "HOUR": 3600, "DAY": 86400}
DEFAULT_GRANULARITY = "DAY"
SECONDS_PER_DAY = 86400


def _div(left: Column, right: Column) -> Column:
    """Whole-number division that truncates toward zero."""
    return F.call_function("div", left, right)


def normalise_granularity(granularity: Column) -> Column:
    return F.when(is_blank(granularity), F.lit(DEFAULT_GRANULARITY)).otherwise(
        F.upper(trim_control(granularity))
    )


def step_seconds(granularity: Column) -> Column:
    """Width of a slice; an unknown name ends the query."""
    name = normalise_granularity(granularity)
    widths = F.coalesce(*[F.when(name == n, F.lit(s)) for n, s in STEP_SECONDS.items()])
    unknown = F.raise_error(F.concat(F.lit("unknown slice granularity: "), granularity))
    return F.coalesce(widths, unknown.cast("int")).cast("bigint")


def granularity_name(seconds: Column) -> Column:
    """Name for a slice width; any other width counts as the default."""
    named = [F.when(seconds == s, F.lit(n)) for n, s in STEP_SECONDS.items()]
    return F.coalesce(*named, F.lit(DEFAULT_GRANULARITY))


def window_slices(days: Column, step: Column) -> Column:
    """How many slices a window of that many days holds, one at least."""
    whole_days = F.greatest(F.lit(1), days).cast("bigint")
    return F.greatest(F.lit(1), _div(whole_days * SECONDS_PER_DAY, step)).cast("int")


def event_second(epoch_ms: Column) -> Column:
    return _div(epoch_ms, F.lit(1000))


def slice_start(epoch_ms: Column, step: Column) -> Column:
    """First second of the slice that holds the event."""
    return slice_start_at(event_second(epoch_ms), step)


def slice_start_at(second: Column, step: Column) -> Column:
    return _div(second, step) * step


def slice_key(ref_name: Column, dimension_key: Column, granularity: Column, slice_ts: Column) -> Column:
    return F.concat_ws(":", F.lit("ind"), ref_name, dimension_key, granularity, slice_ts.cast("string"))


def ttl_seconds(step: Column, slices: Column) -> Column:
    """How long a slice is kept: its window plus one slice."""
    return step * F.greatest(F.lit(1), slices) + step


def partition_key(ref_name: Column, dimension_key: Column) -> Column:
    return F.concat_ws("|", ref_name, dimension_key)
