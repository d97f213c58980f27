"""What one order does to a running value, for scripts that can only be applied order by order.

Spark analyses a script.  Every part of it that does not read ``current`` stays a Spark expression and becomes an
argument column, computed for all orders at once.  What is left, the few operations between ``current`` and the result,
becomes a small step over numbers that a reader of ordered rows calls once for each order.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce
from typing import Any

import numpy as np

Number = float | None


def _strict(f: Callable) -> Callable:
    def null_safe(*values: Number) -> Any:
        return None if None in values else f(*values)

    return null_safe


def _nan_last(value: float) -> tuple[bool, float]:
    return (True, 0.0) if value != value else (False, value)


def _extreme(pick: Callable) -> Callable:
    def of(*values: Number) -> Number:
        known = [v for v in values if v is not None]
        return pick(known, key=_nan_last) if known else None

    return of


def _and(a: Any, b: Any) -> bool | None:
    if (a is not None and not a) or (b is not None and not b):
        return False
    return None if a is None or b is None else True


def _or(a: Any, b: Any) -> bool | None:
    if a or b:
        return True
    return None if a is None or b is None else False


def _case(*branches: Any) -> Number:
    for condition, value in zip(branches[::2], branches[1::2], strict=False):
        if condition:
            return value
    return branches[-1] if len(branches) % 2 else None


def _among(value: Number, *options: Number) -> bool | None:
    if value is None:
        return None
    return True if value in options else (None if None in options else False)


def _divided(a: float, b: float) -> Number:
    return None if b == 0 else a / b


def _remainder(a: float, b: float) -> Number:
    return None if b == 0 else math.fmod(a, b) if math.isfinite(a) else math.nan


def _positive_remainder(a: float, b: float) -> Number:
    rest = _remainder(a, b)
    return rest if rest is None or rest >= 0 else math.fmod(rest + b, b)


def _rounded(value: float, places: float) -> float:
    if not math.isfinite(value):
        return value
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-int(places)), ROUND_HALF_UP))


def _whole(value: float) -> float:
    return float(math.trunc(value)) if math.isfinite(value) else value


def _root(value: float) -> float:
    return math.sqrt(value) if value >= 0 else math.nan


#: Operations by the name of Spark's expression; the answer is null if an operand is.
_STRICT: dict[str, Callable] = {
    "Add": lambda a, b: a + b,
    "Subtract": lambda a, b: a - b,
    "Multiply": lambda a, b: a * b,
    "UnaryMinus": lambda a: -a,
    "UnaryPositive": lambda a: a,
    "Abs": abs,
    "Floor": lambda a: float(math.floor(a)) if math.isfinite(a) else a,
    "Ceil": lambda a: float(math.ceil(a)) if math.isfinite(a) else a,
    "Round": _rounded,
    "Sqrt": _root,
    "EqualTo": lambda a, b: _nan_last(a) == _nan_last(b),
    "LessThan": lambda a, b: _nan_last(a) < _nan_last(b),
    "LessThanOrEqual": lambda a, b: _nan_last(a) <= _nan_last(b),
    "GreaterThan": lambda a, b: _nan_last(a) > _nan_last(b),
    "GreaterThanOrEqual": lambda a, b: _nan_last(a) >= _nan_last(b),
    "Not": lambda a: not a,
}
#: The same, but null for a divisor of zero too.
_DIVISIONS: dict[str, Callable] = {
    "Divide": _divided,
    "Remainder": _remainder,
    "Pmod": _positive_remainder,
    "IntegralDivide": lambda a, b: None if b == 0 else _whole(a / b),
}
_OTHERS: dict[str, Callable] = {
    "If": lambda c, a, b: a if c else b,
    "CaseWhen": _case,
    "Coalesce": lambda *v: next((x for x in v if x is not None), None),
    "Greatest": _extreme(max),
    "Least": _extreme(min),
    "And": _and,
    "Or": _or,
    "In": _among,
    "IsNull": lambda a: a is None,
    "IsNotNull": lambda a: a is not None,
    "EqualNullSafe": lambda a, b: a == b,
}
_OPERATIONS = {**{n: _strict(f) for n, f in {**_STRICT, **_DIVISIONS}.items()}, **_OTHERS}


def _before(a: Any, b: Any) -> Any:
    last = np.isnan(b)
    return np.where(last, np.logical_not(np.isnan(a)), np.less(a, b)) if np.any(last) else np.less(a, b)


def _equal(a: Any, b: Any) -> Any:
    return np.equal(a, b) | (np.isnan(a) & np.isnan(b))


#: The operations that give the same over arrays without nulls.
_VECTORS: dict[str, Callable] = {
    "Add": np.add,
    "Subtract": np.subtract,
    "Multiply": np.multiply,
    "UnaryMinus": np.negative,
    "UnaryPositive": np.positive,
    "Abs": np.abs,
    "Floor": np.floor,
    "Ceil": np.ceil,
    "Sqrt": np.sqrt,
    "EqualTo": _equal,
    "LessThan": _before,
    "LessThanOrEqual": lambda a, b: np.logical_not(_before(b, a)),
    "GreaterThan": lambda a, b: _before(b, a),
    "GreaterThanOrEqual": lambda a, b: np.logical_not(_before(a, b)),
    "Not": np.logical_not,
    "And": np.logical_and,
    "Or": np.logical_or,
    "If": np.where,
    "Greatest": lambda *v: reduce(np.maximum, v),
    "Least": lambda *v: reduce(np.fmin, v),
}
#: Spark writes these as other expressions; their only child is what they mean.
_REWRITTEN = ("Nvl", "Nvl2", "IfNull", "NullIf", "Between", "Decode", "NullIfZero", "ZeroIfNull")
_NUMBERS = ("double", "float", "int", "bigint")


@dataclass(frozen=True)
class Step:
    """A step: ``source`` over the running value ``c`` and the arguments ``x``, which are SQL over the order's fields."""

    source: str
    arguments: tuple[str, ...]
    #: Whether it depends on the running value if the step fails.
    may_fail: bool

    def function(self) -> Callable[[Number, tuple], Number]:
        """The step as a function; the source is made of operation names and positions only."""
        return eval(f"lambda c, x: {self.source}", {"__builtins__": {}, **_OPERATIONS})  # noqa: S307

    def vector(self) -> Callable[[np.ndarray, list], Any] | None:
        """The step over arrays of values and of arguments that are not null, if its operations allow it."""
        found = eval(f"lambda c, x: {self.source}", {"__builtins__": {}, **_VECTORS})  # noqa: S307
        known = "None" not in self.source and _VECTORS.keys() >= set(found.__code__.co_names)
        return found if known else None


class NoStep(ValueError):
    """A script whose use of ``current`` has no step."""


#: What decides whether a part is null: a set of facts about the arguments, or None where the running value decides too.
Facts = frozenset | None


def _union(facts: list[Facts]) -> Facts:
    return None if None in facts else frozenset().union(*facts)


class _Reading:
    """One walk over an analysed script."""

    def __init__(self, current: str, never_null: str):
        self.current, self.never_null = current, never_null
        self.arguments: dict[str, int] = {}
        self.shared: dict[str, tuple[str, Facts]] = {}

    def of(self, node: Any) -> tuple[str, Facts]:
        kind = node.getClass().getSimpleName()
        if kind == "TypedNullLiteral":
            return "None", None
        if not self._moves(node):
            return self._argument(node)
        children = [node.children().apply(i) for i in range(node.children().size())]
        if kind == "AttributeReference":
            return "c", frozenset()
        if kind == "CommonExpressionRef":
            return self.shared[node.id().toString()]
        if kind == "With":
            for definition in children[1:]:
                self.shared[definition.id().toString()] = self.of(definition.child())
            return self.of(children[0])
        if kind in _REWRITTEN:
            return self.of(children[0])
        if kind == "Cast":
            source, facts = self.of(children[0])
            wanted, given = node.dataType().simpleString(), children[0].dataType().simpleString()
            if wanted not in _NUMBERS or given not in (*_NUMBERS, "boolean"):
                raise NoStep(f"cast from {given} to {wanted}")
            if wanted in ("int", "bigint") and given in ("double", "float"):
                raise NoStep("cast to a whole number")
            return (f"Coalesce({source})", facts) if given == "boolean" else (source, facts)
        if kind not in _OPERATIONS:
            raise NoStep(kind)
        read = [self.of(child) for child in children]
        return f"{kind}({', '.join(source for source, _ in read)})", self._facts(kind, children, read)

    def _moves(self, node: Any) -> bool:
        """Whether the running value has a part in it."""
        kind = node.getClass().getSimpleName()
        if kind == "AttributeReference":
            return node.name() == self.current
        if kind == "CommonExpressionRef":
            return True
        children = node.children()
        return any(self._moves(children.apply(i)) for i in range(children.size()))

    def _argument(self, node: Any) -> tuple[str, Facts]:
        if node.foldable():
            value = node.eval(None)
            if value is None:
                return "None", frozenset({"null"})
            return repr(float(str(value))) if not isinstance(value, bool) else repr(value), frozenset()
        if node.dataType().simpleString() not in (*_NUMBERS, "boolean"):
            raise NoStep(f"{node.dataType().simpleString()} beside the running value")
        number = self.arguments.setdefault(node.sql(), len(self.arguments))
        known = node.getClass().getSimpleName() == "AttributeReference" and node.name().startswith(self.never_null)
        return f"x[{number}]", frozenset() if known else frozenset({number})

    def _facts(self, kind: str, children: list, read: list[tuple[str, Facts]]) -> Facts:
        facts = [f for _, f in read]
        if kind in _STRICT:
            return _union(facts)
        if kind in _DIVISIONS:
            return None if self._moves(children[1]) else _union([*facts, frozenset({("zero", read[1][0])})])
        if kind in ("IsNull", "IsNotNull", "EqualNullSafe"):
            return None if None in facts else frozenset()
        if kind in ("Greatest", "Least", "Coalesce"):
            if None in facts:
                return None
            return frozenset() if frozenset() in facts else frozenset({("all", *map(str, facts))})
        if kind in ("If", "CaseWhen"):
            return self._choice(children, read)
        return frozenset() if all(f == frozenset() for f in facts) else None

    def _choice(self, children: list, read: list[tuple[str, Facts]]) -> Facts:
        if len(children) % 2 == 0:  # no other case: null
            read = [*read, ("None", frozenset({"null"}))]
        conditions = [i for i in range(0, len(read) - 1, 2)]
        values = [read[i + 1][1] for i in conditions] + [read[-1][1]]
        if None in values:
            return None
        if all(v == values[0] for v in values):
            return values[0]
        if any(self._moves(children[i]) for i in conditions):
            return None
        return frozenset({("case", *(read[i][0] for i in conditions), *map(str, values))})


def step_of(frame: Any, current: str, never_null: str) -> Step:
    """The step of a script given as the only column of an analysed frame; ``never_null`` begins the names of numbers."""
    alias = frame._jdf.queryExecution().analyzed().expressions().apply(0)
    reading = _Reading(current, never_null)
    source, facts = reading.of(alias.child())
    return Step(source, tuple(reading.arguments), facts is None)
