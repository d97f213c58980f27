"""Running slice values of many definitions that route alike.

Definitions of the same event types, dimensions and slice width put an order into the same slice.  Where there are many,
orders are dealt to slices and read in arrival order before they fan out, so orders travel and are stored, and not their
pairs with definitions.  A slice's orders are read once for each block of definitions, whose running values are one vector.

Where the running value decides which delivery of an order counts, the reader remembers the orders that come again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyline.functions import slices
from tallyline.functions.script import FOLDS
from tallyline.functions.step import Step
from tallyline.operators.accumulate import HOT_ORDER, SHARES, WIDE
from tallyline.operators.evaluate import argument_columns, evaluate_scripts
from tallyline.operators.route import OVERRIDDEN, input_columns, route
from tallyline.session import stored
from tallyline.sources.definitions import DefinitionSet

#: Definitions of a block: whether each counts an order are the bits of one number.
BLOCK = 64
GENERAL, SUM, MAX, MIN, LAST, AFFINE, ORDERED = range(len(FOLDS))
_UNIT = ("first", "last", "dimension_key", "unit")
_STEPPED = (GENERAL, ORDERED)
_NEVER = -(2**63)


@dataclass(frozen=True)
class Family:
    """Definitions that route alike, in the order of their places; the first one routes for all."""

    lead: int
    first: int
    #: Definition, fold and script of each.
    members: tuple[tuple[int, int, int], ...]
    #: Whether the running value decides which delivery of an order counts.
    ordered: bool = False

    def blocks(self, width: int) -> list[tuple[int, int, int, int, int, int]]:
        """Lead, width, block, first and last place of each part of a block, and the bit of its first place."""
        found = []
        for at in range(0, len(self.members), width):
            last = min(at + width, len(self.members)) - 1
            found.append((self.lead, width, at // BLOCK, self.first + at, self.first + last, at % BLOCK))
        return found


def families(orders: DataFrame, definitions: DefinitionSet, least: int = WIDE) -> list[Family]:
    """Families of at least that many definitions of a backfill."""
    if orders.isStreaming or not definitions.small or definitions.repeated_refs or definitions.fan_out < least:
        return []
    dimensions = [c for i in range(definitions.max_dimensions) for c in (f"dim_{i}", f"label_{i}")]
    known = definitions.table.select("def_ord", "fold", "script_id", "slice_seconds", "route_keys", *dimensions).collect()
    alike: dict[tuple, list[tuple[int, int, int]]] = {}
    for row in known:
        route_of = (row.fold == ORDERED, frozenset(row.route_keys), row.slice_seconds, *(row[d] for d in dimensions))
        alike.setdefault(route_of, []).append((row.def_ord, row.fold, row.script_id))
    found, first = [], 0
    for (is_ordered, *_), members in alike.items():
        if len(members) >= least:
            ordered = sorted(members, key=lambda m: (m[1], m[2], m[0]))
            found.append(Family(ordered[0][0], first, tuple(ordered), is_ordered))
            first += len(ordered)
    return found


def wide_values(orders: DataFrame, definitions: DefinitionSet, found: Sequence[Family], part: int) -> DataFrame:
    """The value of a slice after each counted order, for the definitions of these families."""
    routed = _routed(orders, definitions, found)
    again = _repeated(routed)
    rows = _units(routed, again, found)
    narrow = _narrow_units(rows, found, part)
    pairs = _evaluated(_dealt(_counted(rows, again, definitions, found), definitions, found, narrow), definitions, found, folds=True)
    fold, chosen = F.col("fold"), F.col("increment")
    marked = F.getbit("mask", (F.col("place") - F.col("first") + F.col("bit")).cast("int")) == 1
    # an extreme passes over an order without operand
    operand = F.coalesce("operand", F.when(fold == MAX, F.lit(float("-inf"))).when(fold == MIN, F.lit(float("nan"))))
    step = F.when(F.col(OVERRIDDEN) | fold.isin(SUM, LAST), chosen).otherwise(operand)
    step = F.when(fold == ORDERED, F.lit(1.0)).when(chosen.isNotNull(), F.when(fold == GENERAL, F.lit(1.0)).otherwise(step))
    given = [F.col(c) for c in argument_columns(definitions)] or [F.lit(None).cast("double")]
    given[0] = F.when(fold == AFFINE, F.col("factor")).otherwise(given[0])
    # what belongs to the order travels to its reader once, and all in few columns: Spark measures each column at each row
    head = F.struct(*_UNIT, *_ORDER[1:], "again", F.col("own_current").cast("string").alias("own_current"), F.col(OVERRIDDEN).alias("own"))
    inputs = pairs.select(
        F.when(F.col("place") == F.col("first"), F.to_json(head, {"ignoreNullFields": "false"})).alias("order"),
        F.array(F.when(marked, step), *given).alias("inputs"),
    )
    members = [m[1:] for family in found for m in family.members]
    steps = {n: s.step for n, s in enumerate(definitions.scripts) if s.step}
    read = inputs.mapInArrow(partial(_folded, members=members, steps=steps), _READ)
    values = read.select(*_ORDER, "first", F.posexplode("readings").alias("nth", "running_value"))
    values = values.where(F.col("running_value").isNotNull()).withColumn("place", F.col("first") + F.col("nth"))
    named = values.join(F.broadcast(_placed(definitions, found, "ref_name", "slice_seconds")), "place")
    name = slices.granularity_name(F.col("slice_seconds"))
    return named.withColumn("slice_key", slices.slice_key(F.col("ref_name"), F.col("dimension_key"), name, F.col("slice_ts")))


def _placed(definitions: DefinitionSet, found: Sequence[Family], *columns: str) -> DataFrame:
    """The definitions of the families by their places."""
    places = [(f.first + n, m[0]) for f in found for n, m in enumerate(f.members)]
    table = definitions.spark.createDataFrame(places, "place long, def_ord long")
    return table.join(F.broadcast(definitions.table.select("def_ord", *columns)), "def_ord").drop("def_ord")


def _routed(orders: DataFrame, definitions: DefinitionSet, found: Sequence[Family]) -> DataFrame:
    """One row for each order and family, stored, with a number of its own."""
    leads = definitions.with_table(definitions.table.where(F.col("def_ord").isin([f.lead for f in found])))
    start = slices.slice_start(F.col("event_epoch_ms"), F.col("slice_seconds"))
    rows = route(orders, leads).select(
        F.col("def_ord").alias("lead"),
        "dimension_key",
        start.alias("slice_ts"),
        "order_id",
        "arrival_seq",
        *input_columns(definitions).values(),
        OVERRIDDEN,
        F.monotonically_increasing_id().alias("delivery"),
    )
    return stored(rows, "routed")


def _evaluated(dealt: DataFrame, definitions: DefinitionSet, found: Sequence[Family], folds: bool) -> DataFrame:
    """Each row with each definition of its block, in the order of the rows and of the places."""
    # a row generator keeps the order of its rows and, unlike a join, the sort below it
    placed = dealt.withColumn("place", F.explode(F.sequence("first", "last")))
    table = _placed(definitions, found, "script_id", "params", "slots", "fold")
    return evaluate_scripts(placed.join(F.broadcast(table), "place"), definitions, folds)


def _blocks(definitions: DefinitionSet, found: Sequence[Family], widths: Sequence[int]) -> DataFrame:
    rows = [b for family in found for width in widths for b in family.blocks(width)]
    return definitions.spark.createDataFrame(rows, "lead long, width int, block int, first long, last long, bit int")


def _repeated(routed: DataFrame) -> DataFrame | None:
    """Orders that a key meets more than once, if there are any."""
    times = routed.groupBy("lead", "dimension_key", "order_id").agg(
        F.count("*").alias("times"), F.max("arrival_seq").alias("latest"), F.min("slice_ts").alias("low"), F.max("slice_ts").alias("high")
    )
    found = stored(times.where("times > 1"), "repeated")
    return None if found.isEmpty() else found


def _units(routed: DataFrame, repeated: DataFrame | None, found: Sequence[Family]) -> DataFrame:
    """Whether an order comes again, where a reader asks, and the slice that is read by itself.

    Keys in which an order comes into two slices are read as a whole where the running value decides which one counts.
    """
    once = F.lit(None).cast("boolean")
    asked = [f.lead for f in found if f.ordered]
    if repeated is None or not asked:
        return routed.withColumns({"again": once, "unit": F.col("slice_ts")})
    repeated = repeated.where(F.col("lead").isin(asked))
    key = ["lead", "dimension_key"]
    crossing = repeated.where("low < high").select(*key).distinct().withColumn("crosses", F.lit(True))
    rows = routed.join(repeated.select(*key, "order_id", "latest"), [*key, "order_id"], "left").join(crossing, key, "left")
    # null: comes once; true: comes again later
    rows = rows.withColumn("again", F.when(F.col("latest").isNotNull(), F.col("arrival_seq") < F.col("latest")))
    return rows.withColumn("unit", F.when(F.col("crosses").isNull(), F.col("slice_ts"))).drop("latest", "crosses")


def _counted(rows: DataFrame, repeated: DataFrame | None, definitions: DefinitionSet, found: Sequence[Family]) -> DataFrame:
    """Deliveries that may count, with a bit for each definition of the block ``of``; of all blocks if it is null.

    A delivery that comes once needs no comparison.  For the others, the definitions' first successes are sought, unless
    these depend on running values.
    """
    settled = [f.lead for f in found if not f.ordered]
    everywhere = {"of": F.lit(None).cast("int"), "mask": F.lit(-1).cast("bigint")}
    if repeated is None or not settled:
        return rows.withColumns(everywhere)
    times = repeated.where(F.col("lead").isin(settled)).select(
        "times", *[F.col(c).alias(f"again_{c}") for c in ("lead", "dimension_key", "order_id")]
    )
    same = (F.col("lead") == F.col("again_lead")) & F.col("dimension_key").eqNullSafe(F.col("again_dimension_key"))
    same = same & F.col("order_id").eqNullSafe(F.col("again_order_id"))
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.broadcast(_blocks(definitions, found, [BLOCK]))

    def first(deliveries: DataFrame) -> DataFrame:
        pairs = _evaluated(deliveries.join(blocks, "lead"), definitions, found, folds=False)
        pairs = pairs.where(F.col("increment").isNotNull()).withColumn("nth", F.col("place") - F.col("first") + F.col("bit"))
        earliest = F.min_by("delivery", F.coalesce("arrival_seq", F.lit(_NEVER)))
        winners = pairs.groupBy("order_id", "lead", "dimension_key", "block", "nth").agg(earliest.alias("delivery"))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("nth").cast("int"))
        return winners.groupBy("order_id", "delivery", F.col("block").alias("of")).agg(F.bit_or(bit).alias("mask"))

    several = rows.join(times.where(F.col("times") <= HOT_ORDER), same, "left_semi")
    hot = rows.join(times.where(F.col("times") > HOT_ORDER), same, "left_semi")
    masks = first(several.repartition(SHARES * usual, "order_id")).unionByName(first(hot))
    once = rows.join(times, same, "left_anti").withColumns(everywhere)
    return once.unionByName(rows.join(masks.drop("order_id"), "delivery"))


def _narrow_units(rows: DataFrame, found: Sequence[Family], part: int) -> list[tuple]:
    """Units that hold more of the work than half a core's share, and how many definitions one reader of theirs takes.

    There can be four times as many as cores at most.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = {f.lead: len(f.members) for f in found}
    orders = {r.lead: r["count"] for r in rows.groupBy("lead").count().collect()}
    share = sum(n * size[lead] for lead, n in orders.items()) / (2 * cores)
    counts = rows.groupBy("lead", "dimension_key", "unit").count().where(F.col("count") > max(part, share / BLOCK))
    long = counts.orderBy(F.desc("count")).limit(4 * cores).collect()
    # a power of two, so that none crosses the bounds of a block
    return [(*r[:3], min(BLOCK, 1 << max(0, int(share / r["count"]).bit_length() - 1))) for r in long]


def _dealt(counted: DataFrame, definitions: DefinitionSet, found: Sequence[Family], narrow: Sequence[tuple]) -> DataFrame:
    """Deliveries for each block, every unit of a block in one task and in the order of arrival."""
    wanted: Column = F.lit(BLOCK)
    if narrow:
        table = definitions.spark.createDataFrame(list(narrow), "n_lead long, n_key string, n_unit long, n_width int")
        same = (F.col("lead") == F.col("n_lead")) & (F.col("dimension_key") == F.col("n_key"))
        counted = counted.join(F.broadcast(table), same & F.col("unit").eqNullSafe(F.col("n_unit")), "left")
        wanted = F.coalesce("n_width", wanted)
    counted = counted.withColumn("width", wanted).drop("n_lead", "n_key", "n_unit", "n_width")
    blocks = _blocks(definitions, found, sorted({BLOCK, *(row[3] for row in narrow)}))
    dealt = counted.join(F.broadcast(blocks), ["lead", "width"]).where(F.col("of").isNull() | (F.col("of") == F.col("block")))
    # a number of its own: these rows are small until they fan out, so Spark would merge the tasks by their size
    conf, cores = definitions.spark.conf, definitions.spark.sparkContext.defaultParallelism
    tasks = max(SHARES * cores, int(conf.get("spark.sql.shuffle.partitions")))
    narrowed = dealt.drop("lead", "width", "of", "block").repartition(tasks, *_UNIT)
    return narrowed.sortWithinPartitions(*_UNIT, "arrival_seq", "delivery")


# ---------------------------------------------------------------- reading

_ORDER = ("dimension_key", "slice_ts", "order_id", "arrival_seq")
_READ = "dimension_key string, slice_ts long, order_id string, arrival_seq long, first long, readings array<double>"


def _stretches(members: Sequence[tuple[int, int]]) -> list[tuple[int, int, slice]]:
    """Fold, script and places of neighbours that share them; only steps tell scripts apart."""
    found: list[tuple[int, int, slice]] = []
    for n, (fold, script) in enumerate(members):
        number = script if fold in _STEPPED else -1
        if found and found[-1][:2] == (fold, number):
            found[-1] = (fold, number, slice(found[-1][2].start, n + 1))
        else:
            found.append((fold, number, slice(n, n + 1)))
    return found


def _whole_orders(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], np.ndarray, np.ndarray | None]]:
    """Orders, and the inputs of their definitions one after another and where these are null."""
    rest = None
    for part in parts:
        if not part.num_rows:
            continue
        if rest is not None:
            part = pa.Table.from_batches([rest, part]).combine_chunks().to_batches()[0]
            rest = None
        order = part.column("order")
        orders = [json.loads(text) for text in order.drop_null().to_pylist()]
        starts = np.flatnonzero(order.is_valid().to_numpy(zero_copy_only=False))
        sizes = np.array([o["last"] - o["first"] + 1 for o in orders])
        end = int(starts[-1] + sizes[-1])
        whole = part.num_rows
        if end > whole:
            whole = end = int(starts[-1])
            rest = part.slice(whole)
            orders, starts, sizes = orders[:-1], starts[:-1], sizes[:-1]
        if end != whole or (np.cumsum(sizes) - sizes != starts).any():
            raise RuntimeError("orders came without all their definitions, or not in order")
        if orders:
            inputs = part.column("inputs").slice(0, whole).flatten()
            shape = (whole, -1)
            nulls = inputs.is_null().to_numpy(zero_copy_only=False).reshape(shape) if inputs.null_count else None
            yield orders, inputs.to_numpy(zero_copy_only=False).reshape(shape), nulls
    if rest is not None:
        raise RuntimeError("the last order came without all its definitions")


def _folded(parts: Iterator[pa.RecordBatch], members: Sequence[tuple[int, int]], steps: Mapping[int, Step]) -> Iterator[pa.RecordBatch]:
    """The readings of each order, one for each definition of its block: null where it does not count.

    What is held is the values of each slice of one unit, and which definitions counted an order that comes again.
    """
    functions = {n: (step.function(), step.vector(), len(step.arguments)) for n, step in steps.items()}
    layouts: dict[tuple[int, int], list[tuple[int, int, slice]]] = {}
    unit: tuple | None = None
    held: dict[int | None, np.ndarray] = {}
    done: dict[str, np.ndarray] = {}
    for orders, inputs, nulls in _whole_orders(parts):
        readings, missing = [], []
        row = 0
        for (key, slice_ts), group in groupby(orders, lambda o: (tuple(o[c] for c in _UNIT), o["slice_ts"])):
            run = list(group)
            if key != unit:
                unit, held, done = key, {}, {}
            first, last = key[:2]
            size = last - first + 1
            if (first, last) not in layouts:
                layouts[first, last] = _stretches(members[first : last + 1])
            values = held.setdefault(slice_ts, np.zeros(size))
            rows, shape = slice(row, row + len(run) * size), (len(run), size, -1)
            row = rows.stop
            given = inputs[rows].reshape(shape)
            empty = np.zeros(given.shape, bool) if nulls is None else nulls[rows].reshape(shape)
            kept = ~empty[:, :, 0]
            out = np.empty(kept.shape)
            repeats = {i: done.setdefault(o["order_id"], np.zeros(size, bool)) for i, o in enumerate(run) if o["again"] is not None}
            for fold, script, places in layouts[first, last]:
                seen = {i: counted[places] for i, counted in repeats.items()}
                works = functions.get(script)
                _fold(fold, works, given[:, places], empty[:, places], kept[:, places], run, seen, values[places], out[:, places])
            for order in run:
                if order["again"] is False:  # the last delivery: nothing asks for it any more
                    done.pop(order["order_id"], None)
            readings.append(out.ravel())
            missing.append(~kept.ravel())
        flat = pa.array(np.concatenate(readings), pa.float64(), mask=np.concatenate(missing), from_pandas=False)
        ends = np.cumsum([o["last"] - o["first"] + 1 for o in orders])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), flat)
        types = {"dimension_key": pa.string(), "order_id": pa.string()}
        names = [*_ORDER, "first"]
        columns = [pa.array([o[c] for o in orders], types.get(c, pa.int64())) for c in names]
        yield pa.record_batch([*columns, lists], names=[*names, "readings"])


def _fold(
    fold: int,
    works: tuple | None,
    inputs: np.ndarray,
    empty: np.ndarray,
    kept: np.ndarray,
    orders: Sequence[dict],
    seen: Mapping[int, np.ndarray],
    values: np.ndarray,
    out: np.ndarray,
) -> None:
    """Apply orders one after another to the values of neighbouring definitions, which are updated in place.

    ``inputs`` are a step, then a factor or a script's arguments.  ``seen`` tells which definitions counted an order that
    comes more than once.
    """
    every = kept.all(axis=1).tolist()
    slow = [False] * len(every)
    if fold in _STEPPED:
        scalar, vector, used = works
        unknown = (empty[:, :, 1 : 1 + used].any(axis=2) & kept).any(axis=1).tolist()
        slow = [vector is None or u or (o["own"] and o["own_current"] is None) for u, o in zip(unknown, orders)]
    with np.errstate(all="ignore"):
        for i, order in enumerate(orders):
            step, factor = inputs[i, :, 0], inputs[i, :, 1]
            counted = seen.get(i)
            if counted is not None:
                kept[i] &= ~counted
            if slow[i]:
                _one_by_one(scalar, order, inputs[i, :, 1:], empty[i, :, 1:], kept[i], values)
                value = values
            elif fold in _STEPPED:
                before = np.full(len(values), float(order["own_current"])) if order["own"] else values
                value = vector(before, inputs[i, :, 1:].T)
            elif order["own"] or fold == LAST:
                value = step
            elif fold == AFFINE:
                value = factor * values + step
            elif fold == SUM:
                value = values + step
            else:
                value = (np.maximum if fold == MAX else np.fmin)(values, step)
            if every[i] and counted is None and not slow[i]:
                values[:] = value
            else:
                np.copyto(values, value, where=kept[i])
            if order["again"]:
                counted |= kept[i]
            out[i] = values


def _one_by_one(
    scalar: Callable, order: dict, inputs: np.ndarray, empty: np.ndarray, kept: np.ndarray, values: np.ndarray
) -> None:
    """One order with inputs that may be null, definition by definition."""
    current = None if order["own_current"] is None else float(order["own_current"])
    for n in np.flatnonzero(kept).tolist():
        x = [None if null else v for v, null in zip(inputs[n].tolist(), empty[n].tolist())]
        value = scalar(current if order["own"] else float(values[n]), x)
        if value is None:
            kept[n] = False
        else:
            values[n] = value
