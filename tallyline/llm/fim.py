"""Fill-in-the-middle transformation: a pipeline of Arrow compute functions over whole batches.

A text is cut into units (a word of letters, or one other character).  Two cut points chosen by the document's id make
a prefix, a middle and a suffix.  Units of all texts of a batch are one flat array beside the row each belongs to; a
unit's ordinal gives its role, and each role's units are joined again to one piece for each row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.llm.common import give_back, packed, small_batches, text_of, unpacked

#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
#: A unit in UTF-8 bytes: letters A-Z, another ASCII character, or one character of several bytes.
_UNIT = rb"([A-Za-z]+|[\x00-\x40\x5b-\x60\x7b-\x7f]|[\xc0-\xff][\x80-\xbf]*)"
#: A byte that no UTF-8 text holds.
_CUT = b"\xff"


def _pieces(texts: pa.Array, low: pa.Array, high: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """Units of each text, and its pieces: units before ``low % (n + 1)`` or ``high % (n + 1)``, whichever is less, those
    before the other, and the rest."""
    marked = pc.replace_substring_regex(texts.cast(pa.binary()), pattern=_UNIT, replacement=rb"\1" + _CUT)
    lists = pc.split_pattern(marked, _CUT)
    # what follows the last mark is an empty piece: it is a unit of no length and no ordinal below n
    n = pc.subtract(pc.cast(pc.list_value_length(lists), pa.int64()), 1)
    units, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    begins = pc.cast(lists.offsets[:-1], pa.int64())
    ordinals = pc.subtract(pc.add(pa.array(np.arange(len(units))), begins[0] if len(begins) else 0), pc.take(begins, parents))
    one, other = (_modulo(x, pc.add(n, 1)) for x in (low, high))
    first, second = pc.min_element_wise(one, other), pc.max_element_wise(one, other)
    roles = pc.add(
        pc.cast(pc.greater_equal(ordinals, pc.take(first, parents)), pa.int8()),
        pc.cast(pc.greater_equal(ordinals, pc.take(second, parents)), pa.int8()),
    )
    return n, [_joined(units, parents, pc.equal(roles, role), len(texts)) for role in range(3)]


def _modulo(values: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(values, pc.multiply(pc.divide(values, by), by))


def _joined(units: pa.Array, parents: pa.Array, chosen: pa.Array, rows: int) -> pa.Array:
    """The chosen units of each row as one value."""
    own = parents.filter(chosen)
    offsets = np.r_[0, np.cumsum(np.bincount(own.to_numpy(), minlength=rows))]
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), units.filter(chosen)), b"")


def _transformed(parts: Iterator[pa.RecordBatch], plain_from: int, spm_below: int, marks: Sequence[str]) -> Iterator[pa.RecordBatch]:
    p, s, m = (pa.scalar(x.encode(), pa.binary()) for x in marks)
    nothing = pa.scalar(b"", pa.binary())
    for part in parts:
        texts = part.column("text")
        h1, h2, h3, h4 = (part.column(f"h{k}") for k in range(1, 5))
        n, (prefix, middle, suffix) = _pieces(texts, h1, h2)
        hundred = pa.array(np.full(part.num_rows, 100))
        plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(h3, hundred), plain_from))
        for mark in marks:
            plain = pc.or_(plain, pc.match_substring(texts, mark))
        spm = pc.less(_modulo(h4, hundred), spm_below)
        by_prefix = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, nothing)
        by_suffix = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, nothing)
        output = pc.if_else(plain, texts.cast(pa.binary()), pc.if_else(spm, by_suffix, by_prefix))
        form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
        none = pa.scalar(None, pa.int64())
        sizes = [pc.if_else(plain, none, pc.cast(pc.utf8_length(x.cast(pa.string())), pa.int64())) for x in (prefix, middle)]
        yield pa.record_batch(
            [part.column("row"), n, form, *sizes, output.cast(pa.string())],
            names=["row", "n_units", "form", "prefix_chars", "middle_chars", "output"],
        )
    give_back()


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
    marks: Sequence[str] = MARKS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The columns of ``docs``, then ``n_units``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Cut points and form come from the SHA-256 of ``seed:id``, so they depend on the id alone: rows with one id are cut
    by the same numbers, a null id counts as empty text.  ``form`` is ``plain`` (the text as it is) for an empty or null
    text, a text that holds a mark, and ``plain_percent`` of the ids; of the others ``spm_percent`` become suffix, prefix,
    middle (``spm``) and the rest prefix, suffix, middle (``psm``).  The character counts are null for plain rows.
    Columns of the new names are replaced.
    """
    small_batches(docs.sparkSession)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    digest = F.sha2(name, 256)
    parts = {f"h{k + 1}": F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)}
    rows = packed(docs, text=text_of(docs, text), **parts)
    shape = StructType([rows.schema["row"]]).add("n_units", "long").add("form", "string")
    shape = shape.add("prefix_chars", "long").add("middle_chars", "long").add("output", "string")
    work = partial(_transformed, plain_from=100 - plain_percent, spm_below=spm_percent, marks=tuple(marks))
    made = rows.mapInArrow(work, shape)
    return unpacked(made, docs.columns, **{c: F.col(c) for c in shape.names[1:]})


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text again, from the output and its form alone: each mark stands once in an output that is not plain."""
    p, s, m = marks

    def between(begin: str, end: str | None) -> Column:
        rest = F.substr(output, F.instr(output, begin) + len(begin))
        if end is None:
            return rest
        return F.substr(output, F.instr(output, begin) + len(begin), F.instr(output, end) - F.instr(output, begin) - F.lit(len(begin)))

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
