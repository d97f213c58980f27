"""Words of Arrow text columns, without a Python object for each word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in order, and how many of them each text has.

    Words are cut at the six ASCII blanks only; ``lower`` lower-cases A-Z.  A null text has no words.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    words, owners = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)  # blanks at the ends of a text leave empty pieces
    owners = owners.filter(full).to_numpy()
    return words.filter(full), np.bincount(owners, minlength=len(texts)).astype(np.int64)


def joined(words: pa.Array, counts: np.ndarray, by: str = " ") -> pa.Array:
    """One text for each count, from so many of the words."""
    offsets = pa.array(np.r_[0, np.cumsum(counts)], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, words), by)
