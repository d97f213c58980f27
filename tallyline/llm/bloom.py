"""Bloom filters of bounded size, folded in the tasks that read the values."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyline.llm.common import batches, give_back, partitions

SEGMENT_BITS = 1 << 20
PROBES = 3
_BITMAP = pa.schema([("segment", pa.int32()), ("bits", pa.binary())])


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values with all bits depending on all bits (the finaliser of SplitMix64)."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def probes(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each 64-bit hash, and its bit positions there (one row for each hash)."""
    segment = (hashes >> np.uint64(40)) % np.uint64(segments)
    low = hashes & np.uint64((1 << 40) - 1)
    step = np.uint64(SEGMENT_BITS - 1)
    bits = np.stack([(low >> np.uint64(s)) * np.uint64(2 * s + 1) & step for s in range(0, 4 * PROBES, 4)], axis=1)
    return segment.astype(np.int64), bits.astype(np.int64)


def holds(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a filter (one row of packed bits for each segment) may hold; it misses none."""
    segment, bits = probes(hashes, len(filter_))
    return (filter_[segment[:, None], bits >> 3] >> (7 - (bits & 7)).astype(np.uint8) & 1).all(axis=1)


def segments_for(values: int, bits_per_value: int, most_bits: int) -> int:
    wanted = min(most_bits, max(SEGMENT_BITS, values * bits_per_value))
    return -(-wanted // SEGMENT_BITS)


def _folded(parts: Iterator[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for part in parts:
        segment, bits = probes(_id_hashes(part.column(0)), segments)
        for s in np.unique(segment).tolist():
            bitmap = held.setdefault(s, np.zeros(SEGMENT_BITS // 8, np.uint8))
            at = bits[segment == s].ravel()
            np.bitwise_or.at(bitmap, at >> 3, (128 >> (at & 7)).astype(np.uint8))
    yield from batches(((s, bitmap.tobytes()) for s, bitmap in held.items()), _BITMAP)
    give_back()


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by segment: one bitmap is held at a time."""

    def rows() -> Iterator[tuple]:
        held, bitmap = None, np.zeros(0, np.uint8)
        for part in parts:
            for segment, bits in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if segment != held:
                    if held is not None:
                        yield held, bitmap.tobytes()
                    held, bitmap = segment, np.zeros(SEGMENT_BITS // 8, np.uint8)
                bitmap |= np.frombuffer(bits, np.uint8)
        if held is not None:
            yield held, bitmap.tobytes()

    yield from batches(rows(), _BITMAP)


def _id_hashes(ids: pa.Array) -> np.ndarray:
    return mixed(ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def filter_of(ids: DataFrame, bits_per_value: int = 16, most_bits: int = 1 << 28) -> np.ndarray:
    """A filter of a column of longs (nulls count as one more value), at most ``most_bits`` large.

    Each task folds its values into bitmaps of its own, which are then merged.  Beyond the bound the filter lets more
    values through.
    """
    segments = segments_for(ids.count(), bits_per_value, most_bits)
    folded = ids.mapInArrow(partial(_folded, segments=segments), "segment int, bits binary")
    tasks = min(segments, partitions(ids.sparkSession))
    whole = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
    merged = folded.repartition(tasks, "segment").sortWithinPartitions("segment").mapInArrow(_merged, "segment int, bits binary")
    for segment, bits in merged.collect():
        whole[segment] = np.frombuffer(bits, np.uint8)
    return whole


def may_hold(filter_: np.ndarray, ids: pa.Array) -> np.ndarray:
    """Which of these ids (nulls too) are in a filter made by ``filter_of``, or seem so."""
    return holds(filter_, _id_hashes(ids))
