"""Text tests and value views that follow the message producers' conventions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

# A decimal JSON token keeps its decimal point when printed, a whole number has none.
_FRACTIONAL = r"^(DOUBLE|FLOAT|DECIMAL\(\d+,[1-9]|DECIMAL\(1?\d,0\))"
_NUMERIC = ("BIG", "DOU", "FLO", "DEC")


def is_blank(text: Column) -> Column:
    """NULL, empty or nothing but whitespace in the Unicode sense (a no-break space is not)."""
    return text.isNull() | ~text.rlike(r"\P{javaWhitespace}")


def trim_control(text: Column) -> Column:
    """Strip spaces and control characters from both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def as_text(value: Column, data_type: T.DataType) -> Column:
    """The printed form of a field value; NULL where the field is absent or null."""
    if not isinstance(data_type, T.VariantType):
        return value.cast("string")
    fractional = F.schema_of_variant(value).rlike(_FRACTIONAL)
    return F.when(fractional, F.try_variant_get(value, "$", "double").cast("string")).otherwise(
        F.try_variant_get(value, "$", "string")
    )


def as_input(value: Column, data_type: T.DataType, wanted: str) -> Column:
    """A field value as a script input of type ``double``, ``string`` or ``boolean``.

    A value of another kind gives NULL: the text ``"100"`` is not a number.
    """
    if isinstance(data_type, T.VariantType):
        kind = F.schema_of_variant(value)
        fits = {
            "double": F.substring(kind, 1, 3).isin(*_NUMERIC),
            "string": kind == "STRING",
            "boolean": kind == "BOOLEAN",
        }[wanted]
        return F.when(fits, F.try_variant_get(value, "$", wanted))
    fits_type = {"double": T.NumericType, "string": T.StringType, "boolean": T.BooleanType}[wanted]
    return value.cast(wanted) if isinstance(data_type, fits_type) else F.lit(None).cast(wanted)


def choose(number: Column, options: Iterable[tuple[int, Column]], default: Column) -> Column:
    """The option with that number, as one flat CASE."""
    chain = None
    for n, value in options:
        chain = F.when(number == n, value) if chain is None else chain.when(number == n, value)
    return default if chain is None else chain.otherwise(default)
