"""Running slice values: what a slice reads after each counted order.

Sums, extremes and replacements are computed as a two-level scan: a slice's orders are cut into
segments by arrival (of about as many orders each, however sparse the arrival numbers are), each segment is scanned by itself, and the few segment results are
scanned over the slice.  A slice that receives most of the feed is so spread over many tasks.

Other scripts are applied order by order by a reader of sorted rows, which carries the value from batch to batch and
holds one slice at a time.  An affine script (``current * 0.5 + amount``) composes besides: a slice of many orders is
cut into parts, each part is one affine step, the few steps are read first, and then all parts side by side.

A script whose success depends on the running value (``if(current < 3, current + a, null)``) decides with it which
delivery of an order counts.  Such an indicator is read by dimension key: an order counts once over all slices of its
key.  Keys that have no order delivered into two slices are read slice by slice all the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline.functions import slices
from tallyline.functions.script import FOLDS
from tallyline.functions.step import Step
from tallyline.operators.accumulate import IDENTITY, counted_orders, delivery_order, first_success
from tallyline.operators.evaluate import argument_columns, route_and_evaluate
from tallyline.operators.route import OVERRIDDEN, join_definitions, may_override
from tallyline.operators.wide import families, wide_values
from tallyline.session import stored
from tallyline.sources.definitions import DefinitionSet

#: Orders per segment of a scan, about.
SEGMENT = 1_000_000
#: Orders of one slice that an affine script takes in one part.
PART = 65_536

SLICE = ("ref_ord", "dimension_key", "slice_ts")
GENERAL, SUM, MAX, MIN, LAST, AFFINE, ORDERED = range(len(FOLDS))
_RESULT = ("ref_name", "dimension_key", "slice_ts", "order_id", "arrival_seq", "slice_key", "running_value")
#: What a fold reads of a counted order, besides its identity.
CARRIED = ("operand", "factor", "own_current", OVERRIDDEN)


def segments_of(rows: DataFrame, size: int) -> Column:
    """The number of the segment that an order's arrival falls into, for segments of about ``size`` orders.

    Arrival numbers may be as sparse as they like: the bounds are quantiles of those that are there, one for each
    segment.  It reads the rows, which should be stored.
    """
    parts = -(-rows.count() // size)
    if parts < 2:
        return F.lit(0).cast("bigint")
    bounds = rows.approxQuantile("arrival_seq", [n / parts for n in range(1, parts)], 1 / (4 * parts))
    known = F.array(*[F.lit(int(b)).cast("bigint") for b in sorted(set(bounds))])
    return F.size(F.filter(known, lambda b: b <= F.col("arrival_seq"))).cast("bigint")


def running(rows: DataFrame, group: Sequence[str], totals: Mapping[str, tuple[str, Column]], segment: Column) -> DataFrame:
    """Add running aggregates over each group in arrival order, the row itself included.

    ``totals`` maps a new column to an aggregate (``sum``, ``max`` or ``min``) and its input; ``segment`` rises with the
    arrival number.
    """
    aggregates = {"sum": F.sum, "max": F.max, "min": F.min}
    merges = {"sum": lambda a, b: a + b, "max": F.greatest, "min": F.least}
    inputs = rows.withColumns(
        {f"{name}_in": value for name, (_, value) in totals.items()}
        | {"segment": segment}
    )
    cell = [*group, "segment"]
    of_segment = inputs.groupBy(*cell).agg(*[aggregates[k](f"{n}_in").alias(f"{n}_part") for n, (k, _) in totals.items()])
    earlier = Window.partitionBy(*group).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    before = of_segment.select(
        *cell, *[aggregates[k](f"{n}_part").over(earlier).alias(f"{n}_before") for n, (k, _) in totals.items()]
    )
    so_far = Window.partitionBy(*cell).orderBy("arrival_seq").rowsBetween(Window.unboundedPreceding, 0)
    inside = inputs.withColumns({f"{n}_here": aggregates[k](f"{n}_in").over(so_far) for n, (k, _) in totals.items()})
    joined = inside.join(before, cell)

    def merged(name: str, kind: str) -> Column:
        here, prior = F.col(f"{name}_here"), F.col(f"{name}_before")
        return F.coalesce(merges[kind](prior, here), here, prior).alias(name)

    return joined.select(*rows.columns, *[merged(name, kind) for name, (kind, _) in totals.items()])


def running_slice_values(
    orders: DataFrame, definitions: DefinitionSet, segment: int = SEGMENT, part: int = PART
) -> DataFrame:
    """The value of a slice after each counted order, in arrival order.

    Scans read the counted orders twice, so building this stores them first; scripts that are read order by order
    need no job before the one that reads the result.  Many definitions that route alike are read together (see
    ``operators.wide``).
    """
    check_steps(definitions)
    together = families(orders, definitions)
    if not together:
        return _result(union(_by_pairs(orders, definitions, segment, part)), definitions)
    results = [wide_values(orders, definitions, together, part).select(*_RESULT)]
    taken = [member[0] for family in together for member in family.members]
    rest = definitions.table.where(~F.col("def_ord").isin(taken))
    kinds = frozenset(FOLDS[r.fold] for r in rest.select("fold").distinct().collect())
    if kinds:
        left = definitions.size - len(taken)
        others = definitions.with_table(rest, size=left, fold_kinds=kinds, fan_out=min(left, definitions.fan_out))
        results.append(_result(union(_by_pairs(orders, others, segment, part)), others))
    return union(results)


def _by_pairs(orders: DataFrame, definitions: DefinitionSet, segment: int, part: int) -> list[DataFrame]:
    """Running values from the pairs of orders and definitions."""
    carry = (*CARRIED, *argument_columns(definitions))
    kinds = definitions.fold_kinds
    results = []
    if "ordered" in kinds:
        evaluated = route_and_evaluate(orders, definitions, folds=True)
    if kinds - {"ordered"}:
        if "ordered" in kinds:
            winners = first_success(evaluated.where(F.col("fold") != ORDERED), definitions, carry)
        else:
            winners = counted_orders(orders, definitions, folds=True, carry=carry)
        results = counted_values(with_facts(winners, definitions), definitions, may_override(orders, definitions), segment, part)
    if "ordered" in kinds:
        results.append(_in_order(evaluated.where(F.col("fold") == ORDERED), definitions))
    return results


def check_steps(definitions: DefinitionSet) -> None:
    """Scripts that are read order by order need a step."""
    if definitions.fold_kinds & {"general", "ordered"}:
        missing = sorted({f"{s.text} ({s.no_step})" for s in definitions.scripts if s.runs and s.step is None})
        if missing:
            raise ValueError(f"these scripts cannot be applied order by order: {missing}")


def with_facts(winners: DataFrame, definitions: DefinitionSet) -> DataFrame:
    facts = definitions.table.select("def_ord", "fold", "script_id")
    return join_definitions(winners, facts, "def_ord", definitions)


def counted_values(
    rows: DataFrame, definitions: DefinitionSet, overrides: bool, segment: int = SEGMENT, part: int = PART
) -> list[DataFrame]:
    """Running values of counted orders, one frame for each way they are made.

    A column ``start`` holds what the slice read before these orders; without it all slices start at 0.
    """
    kinds = definitions.fold_kinds - {"ordered"}
    if "start" not in rows.columns:
        rows = rows.withColumn("start", F.lit(0.0))
    scans = kinds - {"general", "affine"}
    results = []
    if scans or "affine" in kinds:
        rows = stored(rows, "counted")
        place = segments_of(rows, segment)
    if scans:
        chosen = rows.where(~F.col("fold").isin(GENERAL, AFFINE)) if kinds - scans else rows
        results.append(_scan(chosen, scans, place, overrides))
    if "affine" in kinds:
        results.append(_affine(rows.where(F.col("fold") == AFFINE), place, part))
    if "general" in kinds:
        chosen = rows.where(F.col("fold") == GENERAL) if kinds - {"general"} else rows
        results.append(_read(chosen, SLICE, ("arrival_seq",), definitions))
    return results


_VALUE = ("def_ord", "dimension_key", "slice_ts", "order_id", "arrival_seq", "running_value")


def union(results: Sequence[DataFrame]) -> DataFrame:
    found = results[0]
    for other in results[1:]:
        found = found.unionByName(other)
    return found


def _result(values: DataFrame, definitions: DefinitionSet) -> DataFrame:
    names = definitions.table.select("def_ord", "ref_name", "slice_seconds")
    rows = join_definitions(values, names, "def_ord", definitions)
    name = slices.granularity_name(F.col("slice_seconds"))
    key = slices.slice_key(F.col("ref_name"), F.col("dimension_key"), name, F.col("slice_ts"))
    return rows.withColumn("slice_key", key).select(*_RESULT)


# ---------------------------------------------------------------- scans


def _scan(rows: DataFrame, kinds: frozenset[str], segment: Column, overrides: bool) -> DataFrame:
    # An order that brings its own `current` does not build on the slice: a new epoch starts with it.
    group = list(SLICE)
    if overrides:
        rows = stored(running(rows, SLICE, {"epoch": ("sum", F.col(OVERRIDDEN).cast("int"))}, segment), "epochs")
        group.append("epoch")
    else:
        rows = rows.withColumn("epoch", F.lit(0).cast("bigint"))
    # The order that starts an epoch brings its whole increment, not only its operand.
    step = F.when(F.col(OVERRIDDEN), F.col("increment")).otherwise(F.col("operand"))
    totals = {
        "total": ("sum", F.col("increment")),
        "highest": ("max", step),
        "lowest": ("min", step),
    }
    wanted = {"sum": "total", "max": "highest", "min": "lowest"}
    used = {name: totals[name] for kind, name in wanted.items() if kind in kinds}
    if used:
        rows = running(rows, group, used, segment)
    start = F.when(F.col("epoch") == 0, F.col("start"))
    value = F.when(F.col("fold") == LAST, F.col("increment"))
    if "total" in used:
        value = value.when(F.col("fold") == SUM, F.coalesce(start, F.lit(0.0)) + F.col("total"))
    if "highest" in used:
        value = value.when(F.col("fold") == MAX, F.greatest(start, "highest"))
    if "lowest" in used:
        value = value.when(F.col("fold") == MIN, F.least(start, "lowest"))
    return rows.withColumn("running_value", value).select(*_VALUE)


# ---------------------------------------------------------------- order by order

_Carry = Callable[[pa.RecordBatch], tuple[np.ndarray, list]]


def _changes(part: pa.RecordBatch, unit: Sequence[str], last: list | None) -> tuple[list[bool], list]:
    """Where a row belongs to another unit than the row before it, and the last row's unit."""
    new = np.zeros(part.num_rows, bool)
    end = []
    for i, name in enumerate(unit):
        codes = part.column(name).dictionary_encode(null_encoding="encode")
        numbers = codes.indices.to_numpy(zero_copy_only=False)
        new[1:] |= numbers[1:] != numbers[:-1]
        new[0] |= last is None or codes[0].as_py() != last[i]
        end.append(codes[part.num_rows - 1].as_py())
    return new.tolist(), end


def _carried(
    parts: Iterator[pa.RecordBatch], unit: Sequence[str], steps: Mapping[int, Step], arguments: Sequence[str], once: bool
) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit and arrival, with the value after each order; rows that do not count are left out.

    What is held is the value of each slice of one unit and, with ``once``, the counted orders that come again.
    """
    functions = {number: step.function() for number, step in steps.items()}
    last: list | None = None
    values: dict[int, float] = {}
    counted: set[str] = set()
    for part in parts:
        if not part.num_rows:
            continue
        new, last = _changes(part, unit, last)
        column = {name: part.column(name).to_pylist() for name in ("slice_ts", "script_id", OVERRIDDEN, "own_current", "start")}
        inputs = zip(*(part.column(a).to_pylist() for a in arguments), strict=True) if arguments else [()] * part.num_rows
        orders = part.column("order_id").to_pylist() if once else None
        again = part.column("again").to_pylist() if once else None
        kept, readings = [], []
        rows = zip(new, *column.values(), inputs, strict=True)
        for i, (begins, slice_ts, script, own, current, start, x) in enumerate(rows):
            if begins:
                values, counted = {}, set()
            if once and again[i] is not None and orders[i] in counted:
                if not again[i]:  # the last delivery: nothing asks for it any more
                    counted.discard(orders[i])
                continue
            before = values.get(slice_ts, start)
            value = functions[script](current if own else before, x)
            if value is None:
                continue
            values[slice_ts] = value
            if once and again[i]:
                counted.add(orders[i])
            kept.append(i)
            readings.append(float(value))
        chosen = part.take(pa.array(kept, pa.int64()))
        columns = [chosen.column(c) for c in _VALUE[:-1]]
        yield pa.record_batch([*columns, pa.array(readings, pa.float64())], names=list(_VALUE))


_VALUE_TYPES = "def_ord long, dimension_key string, slice_ts long, order_id string, arrival_seq long, running_value double"


def _read(rows: DataFrame, unit: Sequence[str], order: Sequence[str], definitions: DefinitionSet, once: bool = False) -> DataFrame:
    """Apply steps order by order, each unit in one task and in the given order."""
    arguments = argument_columns(definitions)
    steps = {n: s.step for n, s in enumerate(definitions.scripts) if s.step}
    asked = dict.fromkeys((*unit, *order, *_VALUE[:-1], "script_id", OVERRIDDEN, "own_current", "start", *arguments))
    narrow = rows.select(*asked, *(["again"] if once else []))
    dealt = narrow.repartition(*unit).sortWithinPartitions(*unit, *order)
    return dealt.mapInArrow(partial(_carried, unit=unit, steps=steps, arguments=arguments, once=once), _VALUE_TYPES)


def _in_order(evaluated: DataFrame, definitions: DefinitionSet) -> DataFrame:
    """Running values where the value decides which delivery of an order counts.

    Only orders that a key meets more than once have to be remembered, and only until their last delivery.
    """
    place = delivery_order(definitions)
    key = ["ref_ord", "dimension_key"]
    deliveries = evaluated.groupBy(*IDENTITY).agg(
        F.count("*").alias("times"), F.max(place).alias("last"), F.min("slice_ts").alias("low"), F.max("slice_ts").alias("high")
    )
    repeated = deliveries.where("times > 1")
    # keys in which an order comes into two slices are read as a whole
    crossing = repeated.where("low < high").select(*key).distinct().withColumn("crosses", F.lit(True))
    rows = evaluated.where(F.col("script_id").isin([n for n, s in enumerate(definitions.scripts) if s.step]))
    rows = rows.withColumns({"place": place, "start": F.lit(0.0)})
    rows = rows.join(repeated.select(*IDENTITY, "last"), list(IDENTITY), "left").join(crossing, key, "left")
    # null: comes once; true: comes again later
    rows = rows.withColumn("again", F.when(F.col("last").isNotNull(), F.col("place") < F.col("last")))
    rows = rows.withColumn("unit", F.when(F.col("crosses").isNull(), F.col("slice_ts")))
    return _read(rows, (*key, "unit"), ("arrival_seq", "def_ord"), definitions, once=True)


# ---------------------------------------------------------------- affine scripts


def _affine(rows: DataFrame, segment: Column, size: int) -> DataFrame:
    """Running values of affine scripts.  Slices of more than ``size`` orders are cut into parts of that size."""
    # An order that brings its own `current` does not build on the slice.
    a = F.when(F.col(OVERRIDDEN), F.lit(0.0)).otherwise(F.col("factor"))
    b = F.when(F.col(OVERRIDDEN), F.col("increment")).otherwise(F.col("operand"))
    steps = rows.withColumns({"a": a, "b": b}).select(*_VALUE[:-1], "ref_ord", "a", "b", "start")
    # one row for each ``size`` orders at most, and so are the parts below: orders need not travel to meet them
    long = F.broadcast(steps.groupBy(*SLICE).count().where(F.col("count") > size).select(*SLICE))
    numbered = running(steps.join(long, list(SLICE), "left_semi"), SLICE, {"nth": ("sum", F.lit(1).cast("bigint"))}, segment)
    parts = numbered.withColumn("part", F.call_function("div", F.col("nth") - 1, F.lit(size)))
    # one row for each part of a long slice, then what each part starts from
    cell = [*SLICE, "part"]
    whole = _dealt(parts, cell, ("arrival_seq",), _composed, _STEP)
    starts = _dealt(whole, SLICE, ("part",), _begun, "ref_ord long, dimension_key string, slice_ts long, part long, begin double")
    short = steps.join(long, list(SLICE), "left_anti").withColumn("part", F.lit(0).cast("bigint"))
    placed = parts.drop("start").join(F.broadcast(starts.withColumnRenamed("begin", "start")), cell)
    every = short.unionByName(placed.select(*short.columns))
    return _dealt(every, cell, ("arrival_seq",), _affine_values, _VALUE_TYPES)


_STEP = "ref_ord long, dimension_key string, slice_ts long, part long, a double, b double, start double"


def _dealt(rows: DataFrame, unit: Sequence[str], order: Sequence[str], work: Callable, shape: str) -> DataFrame:
    """Each unit in one task, in order."""
    return rows.repartition(*unit).sortWithinPartitions(*unit, *order).mapInArrow(partial(work, unit=tuple(unit)), shape)


def _composed(parts: Iterator[pa.RecordBatch], unit: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """One affine step for each unit: its orders applied one after another."""
    last, row, a, b = None, None, 1.0, 0.0
    for part in parts:
        if not part.num_rows:
            continue
        new, last = _changes(part, unit, last)
        done = []
        for i, (begins, x, y) in enumerate(zip(new, part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True)):
            if begins:
                if row is not None:
                    done.append((*row, a, b))
                row, a, b = (*(part.column(c)[i].as_py() for c in (*unit, "start")),), 1.0, 0.0
            a, b = a * x, b * x + y
        yield _steps(done, unit)
    yield _steps([(*row, a, b)] if row is not None else [], unit)


def _steps(rows: list[tuple], unit: Sequence[str]) -> pa.RecordBatch:
    names = [*unit, "start", "a", "b"]
    table = {n: [r[i] for r in rows] for i, n in enumerate(names)}
    types = {"dimension_key": pa.string(), "start": pa.float64(), "a": pa.float64(), "b": pa.float64()}
    order = [*unit, "a", "b", "start"]
    return pa.record_batch([pa.array(table[n], types.get(n, pa.int64())) for n in order], names=order)


def _begun(parts: Iterator[pa.RecordBatch], unit: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The value that each part of a slice starts from."""
    last, value = None, 0.0
    for part in parts:
        if not part.num_rows:
            continue
        new, last = _changes(part, unit, last)
        begins = []
        for begin, a, b, start in zip(new, *(part.column(c).to_pylist() for c in ("a", "b", "start")), strict=True):
            value = start if begin else value
            begins.append(value)
            value = a * value + b
        columns = [part.column(c) for c in (*unit, "part")]
        yield pa.record_batch([*columns, pa.array(begins, pa.float64())], names=[*unit, "part", "begin"])


def _affine_values(parts: Iterator[pa.RecordBatch], unit: Sequence[str]) -> Iterator[pa.RecordBatch]:
    last, value = None, 0.0
    for part in parts:
        if not part.num_rows:
            continue
        new, last = _changes(part, unit, last)
        readings = []
        for begin, a, b, start in zip(new, *(part.column(c).to_pylist() for c in ("a", "b", "start")), strict=True):
            value = a * (start if begin else value) + b
            readings.append(value)
        columns = [part.column(c) for c in _VALUE[:-1]]
        yield pa.record_batch([*columns, pa.array(readings, pa.float64())], names=list(_VALUE))
