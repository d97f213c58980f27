"""Accumulation scripts: Spark SQL expressions over ``current`` and the order's fields.

A script is checked once, on an empty frame, when a plan is built.  Spark itself says
which names it reads; nothing here looks at the text beyond telling sums and extremes apart.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyline.functions.step import NoStep, Step, step_of
from tallyline.session import null_on_error

CURRENT = "current"
#: How a running slice value is made from order to order.  ``general``: order by order; ``ordered``: so that even the
#: success of an order depends on the value before it.
FOLDS = ("general", "sum", "max", "min", "last", "affine", "ordered")
#: Engine columns carry this prefix while scripts are evaluated, so that no field name meets them.
RESERVED = "__t_"
#: Columns of a definition's own numbers, which are never null.
NUMBER = f"{RESERVED}p"

Path = tuple[str, ...]


@dataclass(frozen=True)
class Script:
    """One distinct script with the names it reads, or the reason it cannot run."""

    text: str
    inputs: Mapping[Path, str]
    problem: str | None = None
    fold: str = "general"
    operand: str | None = None
    #: What an affine script multiplies the slice value by, before it adds its operand.
    factor: str | None = None
    #: What an order does to the value, for folds order by order, or why that has no step.
    step: Step | None = None
    no_step: str | None = None

    @property
    def runs(self) -> bool:
        return self.problem is None

    @property
    def field_names(self) -> set[str]:
        return {path[0] for path in self.inputs}


def _name_parts(quoted: str) -> Path:
    parts = re.findall(r"`((?:[^`]|``)*)`", quoted)
    return tuple(p.replace("``", "`") for p in parts) if parts else (quoted,)


def _missing_name(error: AnalysisException, known: Mapping[Path, str]) -> Path | None:
    """The name Spark could not resolve, or None when the error is about something else."""
    condition = error.getCondition() or ""
    details = error.getMessageParameters() or {}
    if condition.startswith("UNRESOLVED_COLUMN"):
        return _name_parts(details["objectName"])
    if condition == "FIELD_NOT_FOUND":
        roots = {path[0] for path in known if len(path) > 1}
        if len(roots) == 1:
            return (*roots, *_name_parts(details["fieldName"]))
    return None


def bind(values: Mapping[Path, Column]) -> list[Column]:
    """Columns under the names a script uses; a dotted name becomes a struct."""
    flat = [value.alias(path[0]) for path, value in values.items() if len(path) == 1]
    nested: dict[str, dict[Path, Column]] = {}
    for path, value in values.items():
        if len(path) > 1:
            nested.setdefault(path[0], {})[path[1:]] = value
    return flat + [F.struct(*bind(inner)).alias(root) for root, inner in nested.items()]


def _empty_frame(spark: SparkSession, inputs: Mapping[Path, str]) -> DataFrame:
    nulls = {path: F.lit(None).cast(kind) for path, kind in inputs.items()}
    return spark.range(0).select(*bind(nulls))


def frame_of(spark: SparkSession, text: str, inputs: Mapping[Path, str]) -> DataFrame:
    """A script as a double, analysed, over no rows."""
    with null_on_error(spark), _quiet():
        return _empty_frame(spark, inputs).select(F.expr(text).cast("double").alias("value"))


def _check(spark: SparkSession, text: str, types: Mapping[str, str], known: Mapping[Path, str] | None = None) -> Script:
    """Analyse a script; ``known`` are names it is likely to read, which saves Spark's finding them one by one."""
    inputs: dict[Path, str] = dict(known or {})
    while True:
        frame = _empty_frame(spark, inputs)
        try:
            # A filter takes plain expressions only: no aggregate, window or row generator.
            frame.where(F.expr(text).isNotNull())
            result = frame.select(F.expr(text).alias("value"))
        except AnalysisException as error:
            path = _missing_name(error, inputs)
            if path is None or path in inputs:
                return Script(text, inputs, f"does not compile: {error.getCondition()}")
            if any(part.startswith(RESERVED) for part in path):
                return Script(text, inputs, f"reserved name: {'.'.join(path)}")
            inputs[path] = types.get(".".join(path), "double")
            if _ambiguous(inputs):
                return Script(text, inputs, f"ambiguous name: {'.'.join(path)}")
            continue
        if known:
            read = references_of(result)
            inputs = {path: kind for path, kind in inputs.items() if path[0] in read}
        if len(result.columns) != 1 or not isinstance(result.schema[0].dataType, T.NumericType):
            return Script(text, inputs, "does not return a number")
        return Script(text, inputs)


def references_of(frame: DataFrame) -> set[str]:
    """Columns that the only expression of an analysed frame reads."""
    read = frame._jdf.queryExecution().analyzed().expressions().apply(0).references().toSeq()
    return {read.apply(i).name() for i in range(read.size())}


def _ambiguous(inputs: Mapping[Path, str]) -> bool:
    """Two spellings of one name, or a name that is both a value and a parent."""
    spelled: dict[str, Path] = {}
    for path in inputs:
        key = path[0].lower()
        other = spelled.setdefault(key, path)
        if other != path and (len(other) == 1 or len(path) == 1 or other[0] != path[0]):
            return True
    return False


@contextmanager
def _quiet() -> Iterator[None]:
    """Names that do not resolve are the expected answer here, not something to log."""
    logger = logging.getLogger("SQLQueryContextLogger")
    before = logger.disabled
    logger.disabled = True
    try:
        yield
    finally:
        logger.disabled = before


def compile_script(spark: SparkSession, text: str, types: Mapping[str, str]) -> Script:
    """Check a script once per application; the answer depends on its text and declared types only."""
    identity = (spark.sparkContext.applicationId, text, tuple(sorted(types.items())))
    if identity not in _compiled:
        if len(_compiled) >= _KEPT:
            _compiled.clear()
        _compiled[identity] = _compile(spark, text, types)
    return _compiled[identity]


_compiled: dict[tuple, Script] = {}
#: Answers kept; a job that meets more scripts than that checks some again.
_KEPT = 100_000


def check_script(spark: SparkSession, text: str, known: Mapping[Path, str]) -> Script:
    """Whether a script runs and what it reads, the likely names given."""
    with null_on_error(spark), _quiet():
        return _check(spark, text, {}, known)


def compile_template(spark: SparkSession, text: str, slots: Mapping[Path, str]) -> Script:
    """Check a script over the engine's own columns for its numbers and names."""
    return _compile(spark, text, {}, slots)


def _compile(
    spark: SparkSession, text: str, types: Mapping[str, str], known: Mapping[Path, str] | None = None
) -> Script:
    with null_on_error(spark), _quiet():
        script = _check(spark, text, types, known)
        if not script.runs:
            return script
        fold, operand, factor = _fold_of(spark, script, types, known)
    step, no_step = None, None
    try:
        step = step_of(frame_of(spark, text, script.inputs), CURRENT if (CURRENT,) in script.inputs else "", NUMBER)
    except NoStep as reason:
        no_step = str(reason)
    if fold == "general" and step and step.may_fail:
        fold = "ordered"
    return Script(text, script.inputs, None, fold, operand, factor, step, no_step)


# How a running value can be split: the pattern that proposes an operand, and the
# expression the script must mean the same as.
_SHAPES = (
    ("sum", r"\s*current\s*\+(?P<rest>.*)", "current + ({rest})"),
    ("sum", r"(?P<rest>.*)\+\s*current\s*", "current + ({rest})"),
    ("max", r"\s*greatest\s*\(\s*current\s*,(?P<rest>.*)\)\s*", "greatest(current, ({rest}))"),
    ("min", r"\s*least\s*\(\s*current\s*,(?P<rest>.*)\)\s*", "least(current, ({rest}))"),
    (
        "affine",
        rf"\s*current\s*\*\s*(?P<factor>\d+(?:\.\d+)?|{RESERVED}p\d+)\s*\+(?P<rest>.*)",
        "current * {factor} + ({rest})",
    ),
)


def _fold_of(
    spark: SparkSession, script: Script, types: Mapping[str, str], known: Mapping[Path, str] | None
) -> tuple[str, str | None, str | None]:
    """Tell sums, extremes, replacements and affine steps apart from scripts that need a step-by-step fold.

    The pattern only proposes; Spark decides whether both expressions mean the same.
    """
    if (CURRENT,) not in script.inputs:
        return "last", script.text, None
    frame = _empty_frame(spark, script.inputs)
    for fold, pattern, meaning in _SHAPES:
        match = re.fullmatch(pattern, script.text, re.DOTALL | re.IGNORECASE)
        if not match:
            continue
        rest = match["rest"].strip()
        operand = _check(spark, rest, types, known) if rest else None
        if operand is None or not operand.runs or (CURRENT,) in operand.inputs:
            continue
        try:
            parts = {**match.groupdict(), "rest": rest}
            split = frame.select(F.expr(meaning.format(**parts)).alias("value"))
        except AnalysisException:
            continue
        if split.sameSemantics(frame.select(F.expr(script.text).alias("value"))):
            return fold, rest, parts.get("factor")
    return "general", None, None


def scopes(scripts: Iterable[tuple[int, Script]]) -> list[list[tuple[int, Script]]]:
    """Group scripts whose inputs can stand side by side in one frame."""
    groups: list[tuple[dict[Path, str], list[tuple[int, Script]]]] = []
    for numbered in scripts:
        for inputs, members in groups:
            merged = {**inputs, **numbered[1].inputs}
            agrees = all(inputs.get(p, k) == k for p, k in numbered[1].inputs.items())
            if agrees and not _ambiguous(merged):
                inputs.update(merged)
                members.append(numbered)
                break
        else:
            groups.append((dict(numbered[1].inputs), [numbered]))
    return [members for _, members in groups]
