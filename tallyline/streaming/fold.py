"""Running slice values on a stream.

Orders are de-duplicated by Spark's own aggregation state.  Each micro-batch of counted orders is then folded by the
same scans and readers as a backfill, spread over all tasks, starting from the values its slices had before.  Those are
kept as versions in a folder: a batch writes the new values of the slices it touched under its own number and reads
only what earlier batches wrote, so a batch that runs again does the same again.  Now and then all values are written
as one version, and older ones go.

Scripts whose success depends on the running value decide themselves which delivery counts.  They are replayed in
arrival order by a state handler, key by key.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyline.functions import slices
from tallyline.functions.step import Step
from tallyline.operators.evaluate import argument_columns, route_and_evaluate
from tallyline.operators.fold import CARRIED, ORDERED, _result, check_steps, counted_values, union
from tallyline.operators.accumulate import delivery_place
from tallyline.operators.route import OVERRIDDEN, join_definitions, may_override
from tallyline.session import children, remove
from tallyline.sources.definitions import DefinitionSet
from tallyline.streaming.dedupe import first_arrival
from tallyline.streaming.sinks import read_parquet, to_parquet
from tallyline.streaming.state import COMPACT, SliceState

_OUTPUT = (
    "ref_name string, dimension_key string, slice_ts long, order_id string, arrival_seq long,"
    " slice_key string, running_value double"
)
_SLICE = ["ref_name", "dimension_key", "slice_ts"]
_KEY = "ref_name string, dimension_key string, slice_ts long"


class Folding:
    """Folds micro-batches of counted orders."""

    def __init__(self, definitions: DefinitionSet, folder: str, overrides: bool, compact: int = COMPACT):
        self.definitions, self.folder, self.overrides, self.compact = definitions, folder, overrides, compact

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        state = SliceState(spark, f"{self.folder}/state", _KEY, "value double", self.compact)
        state.forget(number)
        work, out = f"{self.folder}/work/batch={number}", f"{self.folder}/values/batch={number}"
        batch.write.mode("overwrite").parquet(work)
        counted = spark.read.schema(batch.schema).parquet(work)
        touched = counted.select(*_SLICE).distinct()
        before = state.latest(state.before(number).join(touched, _SLICE, "left_semi"))
        started = counted.join(before.withColumnRenamed("value", "start"), _SLICE, "left")
        facts = self.definitions.table.select("def_ord", "ref_ord", "fold", "script_id")
        rows = join_definitions(started.drop("ref_name"), facts, "def_ord", self.definitions)
        arguments = {name: F.get("args", F.lit(i)) for i, name in enumerate(argument_columns(self.definitions))}
        rows = rows.withColumns({"start": F.coalesce("start", F.lit(0.0)), **arguments}).drop("args")
        values = union(counted_values(rows, self.definitions, self.overrides))
        _result(values, self.definitions).write.mode("overwrite").parquet(out)
        done = spark.read.schema(_OUTPUT).parquet(out)
        state.write(done.groupBy(*_SLICE).agg(F.max_by("running_value", "arrival_seq").alias("value")), number)
        remove(spark, work)


class SliceReplay(StatefulProcessor):
    """State of one indicator and dimension key: orders counted, and the value of each slice.

    The rows of a key in one micro-batch are put into arrival order here; the source's limit
    per trigger bounds them.
    """

    def __init__(self, steps: Mapping[int, Step]):
        self._steps = steps

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._functions = {number: step.function() for number, step in self._steps.items()}
        self._counted = handle.getMapState("counted", "order_id string", "counted boolean")
        self._values = handle.getMapState("values", "slice_ts long", "value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["arrival_seq", "def_ord"])
        seen: set[str] = set()
        values: dict[int, float] = {}
        changed: set[int] = set()
        known = self._counted.exists()
        readings = []
        columns = (batch[c].tolist() for c in ("slice_ts", "order_id", "arrival_seq", "script_id", "slice_key", "own", "current", "args"))
        for slice_ts, order_id, arrival, script, slice_key, own, current, args in zip(*columns, strict=True):
            if order_id in seen:
                continue
            if slice_ts not in values:
                at = (slice_ts,)
                values[slice_ts] = self._values.getValue(at)[0] if self._values.containsKey(at) else 0.0
            before = values[slice_ts]
            if own:
                before = None if pd.isna(current) else current
            value = self._functions[script](before, [None if pd.isna(a) else a for a in args])
            # most orders of a full slice fail, so the state is asked for those that do not
            if value is None or known and self._counted.containsKey((order_id,)):
                continue
            seen.add(order_id)
            changed.add(slice_ts)
            values[slice_ts] = float(value)
            readings.append((*key, slice_ts, order_id, arrival, slice_key, float(value)))
        for order_id in seen:
            self._counted.updateValue((order_id,), (True,))
        for slice_ts in changed:
            self._values.updateValue((slice_ts,), (values[slice_ts],))
        yield pd.DataFrame(readings, columns=[c.split()[0] for c in _OUTPUT.split(",")])

    def close(self) -> None:
        pass


def running_value_writers(
    orders: DataFrame, definitions: DefinitionSet, folder: str, compact: int = COMPACT
) -> dict[str, DataStreamWriter]:
    """The outputs that keep running values of a stream of orders below ``folder``, by name; each needs a checkpoint."""
    check_steps(definitions)
    evaluated = route_and_evaluate(orders, definitions, folds=True)
    arguments = argument_columns(definitions)
    args = F.array(*arguments) if arguments else F.array().cast("array<double>")
    evaluated = evaluated.withColumn("args", args)
    found = {}
    if definitions.fold_kinds - {"ordered"}:
        good = evaluated.where(F.col("increment").isNotNull() & (F.col("fold") != ORDERED))
        winners = first_arrival(good.withColumn("place", delivery_place()), (*CARRIED, "args"))
        folding = Folding(definitions, folder, may_override(orders, definitions), compact)
        found["folded"] = winners.writeStream.outputMode("update").foreachBatch(folding)
    if "ordered" in definitions.fold_kinds:
        steps = {n: s.step for n, s in enumerate(definitions.scripts) if s.step}
        found["replayed"] = to_parquet(_replayed(evaluated, steps), f"{folder}/replayed", "append")
    return found


def _replayed(evaluated: DataFrame, steps: Mapping[int, Step]) -> DataFrame:
    name = slices.granularity_name(F.col("slice_seconds"))
    key = slices.slice_key(F.col("ref_name"), F.col("dimension_key"), name, F.col("slice_ts"))
    rows = evaluated.where((F.col("fold") == ORDERED) & F.col("script_id").isin(list(steps))).select(
        *_SLICE,
        "order_id",
        "arrival_seq",
        "def_ord",
        "script_id",
        F.col(OVERRIDDEN).alias("own"),
        F.col("own_current").alias("current"),
        "args",
        key.alias("slice_key"),
    )
    return rows.groupBy("ref_name", "dimension_key").transformWithStateInPandas(
        statefulProcessor=SliceReplay(steps), outputStructType=_OUTPUT, outputMode="Append", timeMode="None"
    )


def start_running_values(
    orders: DataFrame, definitions: DefinitionSet, folder: str, checkpoint: str, **trigger
) -> list[StreamingQuery]:
    """Keep running values of a stream of orders below ``folder``; restarts go on from the checkpoints."""
    writers = running_value_writers(orders, definitions, folder)
    return [
        writer.option("checkpointLocation", f"{checkpoint}/{name}").trigger(**trigger).start()
        for name, writer in writers.items()
    ]


def read_running_values(spark: SparkSession, folder: str) -> DataFrame:
    """What the queries above wrote: the value of a slice after each counted order."""
    schema = spark.createDataFrame([], _OUTPUT).schema
    kinds = [f"{folder}/{name}" for name in children(spark, folder) if name in ("values", "replayed")]
    return union([read_parquet(spark, path, schema) for path in kinds] or [spark.createDataFrame([], _OUTPUT)])
