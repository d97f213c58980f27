"""Script evaluation over routed orders."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.functions import slices
from tallyline.functions.script import CURRENT, NUMBER, RESERVED, Path, Script, bind, scopes
from tallyline.functions.text import choose
from tallyline.operators.route import input_columns, join_definitions, route
from tallyline.session import null_on_error
from tallyline.sources.definitions import DefinitionSet

NOT_A_NUMBER = "script returned no number"
_INCREMENT = f"{RESERVED}inc_"
_OPERAND = f"{RESERVED}op_"
_FACTOR = f"{RESERVED}by_"
_ARGUMENT = f"{RESERVED}arg"
#: Scripts that one column chooses among, which bounds the code Spark makes for it.
SCRIPTS_PER_COLUMN = 40


def evaluate_scripts(routed: DataFrame, definitions: DefinitionSet, folds: bool) -> DataFrame:
    """Add ``increment``: the script with a slice value of 0, or NULL where it fails.

    A row runs its own script only: each result column is a choice by script number, among a bounded number of
    scripts, so the input is read once however many scripts there are.  A template's numbers and names come from the
    definition's row.  Engine columns are renamed while scripts run, so a field may have any name.
    """
    columns = input_columns(definitions)
    engine = [c for c in routed.columns if c not in columns.values()]
    hidden = [f"{RESERVED}{c}" for c in engine]
    frame = routed.select(*[F.col(c).alias(h) for c, h in zip(engine, hidden)], *columns.values())
    outputs: list[str] = []

    with null_on_error(routed.sparkSession):
        for scope in scopes((n, s) for n, s in enumerate(definitions.scripts) if s.runs):
            bound = {p: _bound(p, k, definitions) for _, s in scope for p, k in s.inputs.items()}
            engine_side = [*hidden, *columns.values(), *outputs]
            starts = range(0, len(scope), SCRIPTS_PER_COLUMN)
            results = [r for at in starts for r in _results(scope[at : at + SCRIPTS_PER_COLUMN], definitions, folds)]
            frame = frame.select(*engine_side, *bind(bound)).select(*engine_side, *results)
            outputs = frame.columns[len(hidden) + len(columns) :]

    def pick(prefix: str) -> Column:
        found = [F.col(c) for c in outputs if c.startswith(prefix)]  # a script is in one column only
        return F.coalesce(*found, F.lit(None).cast("double"))

    extra = []
    if folds:
        own = columns.get(((CURRENT,), "double"))
        extra = [pick(_OPERAND).alias("operand"), pick(_FACTOR).alias("factor")]
        extra.append((F.col(own) if own else F.lit(0.0)).alias("own_current"))
        extra += [pick(f"{_ARGUMENT}{i}_").alias(c) for i, c in enumerate(argument_columns(definitions))]
    restored = [F.col(h).alias(c) for c, h in zip(engine, hidden)]
    return frame.select(*restored, pick(_INCREMENT).alias("increment"), *extra)


def _bound(path: Path, kind: str, definitions: DefinitionSet) -> Column:
    """What a script's name stands for: an input, or a number or input that the definition gives."""
    columns = input_columns(definitions)
    if (path, kind) in columns:
        return F.col(columns[path, kind])
    slot = path[0]
    if slot not in definitions.slot_options:
        return F.get(F.col(f"{RESERVED}params"), F.lit(int(slot.removeprefix(NUMBER))))
    named = list(columns.values())
    options = definitions.slot_options[slot]
    if len(options) == 1:
        return F.col(named[options[0]])
    place = int(slot.removeprefix(f"{RESERVED}f").split("_")[0])
    return choose(F.get(F.col(f"{RESERVED}slots"), F.lit(place)), [(n, F.col(named[n])) for n in options], F.lit(None).cast(kind))


def argument_columns(definitions: DefinitionSet) -> tuple[str, ...]:
    """Columns for the arguments of steps, where some indicator's running value is made order by order."""
    if not definitions.fold_kinds & {"general", "ordered"}:
        return ()
    return tuple(f"arg_{i}" for i in range(max((len(s.step.arguments) for s in definitions.scripts if s.step), default=0)))


def _results(scripts: Sequence[tuple[int, Script]], definitions: DefinitionSet, folds: bool) -> list[Column]:
    """The increments of some scripts in one column, and what folds need of them in others."""
    number, first = F.col(f"{RESERVED}script_id"), scripts[0][0]

    def chosen(prefix: str, texts: Iterable[tuple[int, str | None]]) -> list[Column]:
        options = [(n, F.expr(text).cast("double")) for n, text in texts if text is not None]
        return [choose(number, options, F.lit(None).cast("double")).alias(f"{prefix}{first}")] if options else []

    results = chosen(_INCREMENT, ((n, s.text) for n, s in scripts))
    if folds:
        results += chosen(_OPERAND, ((n, s.operand) for n, s in scripts))
        results += chosen(_FACTOR, ((n, s.factor) for n, s in scripts))
        for i in range(len(argument_columns(definitions))):
            steps = ((n, s.step.arguments) for n, s in scripts if s.step)
            results += chosen(f"{_ARGUMENT}{i}_", ((n, a[i] if i < len(a) else None) for n, a in steps))
    return results


def route_and_evaluate(orders: DataFrame, definitions: DefinitionSet, folds: bool = False) -> DataFrame:
    """Routed orders with ``increment`` and ``slice_ts``."""
    evaluated = evaluate_scripts(route(orders, definitions), definitions, folds)
    return evaluated.withColumn("slice_ts", slices.slice_start(F.col("event_epoch_ms"), F.col("slice_seconds")))


def failed_scripts(evaluated: DataFrame, definitions: DefinitionSet) -> DataFrame:
    """Routed orders whose script gave no number, with the reason."""
    failed = evaluated.where(F.col("increment").isNull()).select("def_ord", "dimension_key", "order_id", "arrival_seq")
    problems = [(n, F.lit(s.problem)) for n, s in enumerate(definitions.scripts) if not s.runs]
    reason = choose(F.col("script_id"), problems, F.lit(NOT_A_NUMBER))
    named = definitions.table.select("def_ord", "ref_name", "acc_script", reason.alias("reason"))
    rejects = join_definitions(failed, named, "def_ord", definitions)
    return rejects.select("ref_name", "dimension_key", "order_id", "acc_script", "reason")
