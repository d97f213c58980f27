"""Script templates: scripts that differ only in numbers and field names are one expression.

Numbers and names are lifted out of a script's text into columns of its definition, so a plan holds one expression for
each form of script, and each form is checked once.  Where a number's place matters to Spark (a digit count, an index,
a constant that meets another constant) a script is left as it is: Spark's analysis of the script tells.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from tallyline.functions.script import CURRENT, NUMBER, RESERVED, Path, Script, check_script, compile_template, frame_of

_TOKENS = re.compile(
    r"""(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")"""
    r"|(?P<number>(?<![\w.])\d+(?:\.\d+)?(?![\w.]))"
    r"|(?P<name>[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*)(?P<call>\s*\()?"
    r"|(?P<odd>`|--|/\*)"
)
_ENTITIES = ("int", "bigint", "decimal")


@dataclass(frozen=True)
class Shape:
    """A script without its numbers and names; equal shapes mean the same but for these."""

    text: str
    #: Whether each number has a fraction, which decides its type.
    fractions: tuple[bool, ...]
    kinds: tuple[str, ...]


@dataclass(frozen=True)
class Lifted:
    """What was taken out of one script."""

    shape: Shape
    numbers: tuple[float, ...]
    names: tuple[Path, ...]


def number_slot(i: int) -> str:
    return f"{NUMBER}{i}"


def name_slot(i: int, kind: str) -> str:
    return f"{RESERVED}f{i}_{kind}"


def lift(text: str, types: Mapping[str, str], keywords: frozenset[str]) -> Lifted | None:
    """A script's shape, or None for a script that is taken as it is."""
    numbers: list[str] = []
    names: dict[str, int] = {}
    parts, at = [], 0
    for token in _TOKENS.finditer(text):
        parts.append(text[at : token.start()])
        at = token.end()
        if token["odd"]:
            return None
        if token["number"]:
            parts.append(number_slot(len(numbers)))
            numbers.append(token["number"])
            continue
        name = token["name"]
        root = (name or "").split(".")[0].lower()
        if name and root.startswith(RESERVED):
            return None
        if name and not token["call"] and root != CURRENT and root not in keywords:
            slot = names.setdefault(name, len(names))
            parts.append(name_slot(slot, types.get(name, "double")))
        else:
            parts.append(token.group())
    parts.append(text[at:])
    if not types.keys() <= names.keys() or len({n.split(".")[0].lower() for n in names}) < len({n.split(".")[0] for n in names}):
        return None
    shape = Shape("".join(parts), tuple("." in n for n in numbers), tuple(types.get(n, "double") for n in names))
    return Lifted(shape, tuple(map(float, numbers)), tuple(tuple(n.split(".")) for n in names))


def keywords_of(spark: SparkSession) -> frozenset[str]:
    """Words that are no field names in a script, as Spark lists them."""
    identity = spark.sparkContext.applicationId
    if identity not in _keywords:
        _keywords[identity] = frozenset(r[0].lower() for r in spark.sql("SELECT keyword FROM sql_keywords()").collect())
    return _keywords[identity]


_keywords: dict[str, frozenset[str]] = {}


def template_of(spark: SparkSession, lifted: Lifted, text: str) -> Script | None:
    """The template of a shape, checked with one of its scripts; None where they have to be taken one by one."""
    identity = (spark.sparkContext.applicationId, lifted.shape)
    if identity not in _templates:
        _templates[identity] = _checked(spark, lifted, text)
    return _templates[identity]


_templates: dict[tuple, Script | None] = {}


def _checked(spark: SparkSession, lifted: Lifted, text: str) -> Script | None:
    shape = lifted.shape
    names = dict(zip(lifted.names, shape.kinds, strict=True))
    script = check_script(spark, text, {(CURRENT,): "double"} | names)
    if not script.runs or not names.keys() <= script.inputs.keys():
        return None
    if lifted.numbers:
        # a number has to be cast to a double that meets something which is no constant
        alias = frame_of(spark, text, script.inputs)._jdf.queryExecution().analyzed().expressions().apply(0)
        if not _fits(alias.child(), None, None):
            return None
    slots = {(name_slot(i, kind),): kind for i, kind in enumerate(shape.kinds)}
    slots |= {(number_slot(i),): "double" for i in range(len(lifted.numbers))}
    # words that Spark knows too are not lifted, but may be names all the same
    slots |= {path: kind for path, kind in script.inputs.items() if path not in names}
    made = compile_template(spark, shape.text, slots)
    return made if made.runs else None


def _fits(node: Any, parent: Any, above: Any) -> bool:
    kind = node.getClass().getSimpleName()
    if kind == "Literal" and node.dataType().simpleString().startswith(_ENTITIES):
        cast = parent is not None and parent.getClass().getSimpleName() == "Cast"
        if not cast or parent.dataType().simpleString() != "double" or above is None:
            return False
        beside = above.children()
        return any(not beside.apply(i).foldable() for i in range(beside.size()))
    children = node.children()
    return all(_fits(children.apply(i), node, parent) for i in range(children.size()))
