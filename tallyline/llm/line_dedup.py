"""Line de-duplication: two Bloom filters name suspects, only suspects are shuffled.

1. Every scan task folds its documents' line keys into two Bloom filters, one for hashes seen once and one for
   hashes seen twice.  The filters of all tasks are merged bit by bit: a bit that two tasks (or two documents) set
   in the first filter is set in the second.  The second filter has no false negatives for "in two documents".  A task
   hands on the two bitmaps of a segment, or the positions of its bits where these are fewer bytes.
2. Documents are read again; only keys that the second filter holds travel, as 128-bit digests with their document
   id.  Their exact document counts and the last document that holds them are computed there.
3. Documents that have digests to drop get them, and their texts are rebuilt.  A Bloom filter of their ids tells them
   apart where they are read, so all other texts pass without a shuffle.

The filter is sized from the measured number of lines, up to ``most_bits``.  Beyond that bound more lines are
suspected and travel; the result stays exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.llm.bloom import filter_of, may_hold
from tallyline.llm.common import batches, cut, give_back, packed, partitions, small_batches, text_of, unpacked

BLANKS = b" \t\n\x0b\x0c\r"
SEGMENT_BITS = 1 << 20
PROBES = 3
_FOLDED = pa.schema([("segment", pa.int32()), ("packed", pa.bool_()), ("once", pa.binary()), ("twice", pa.binary())])
_BITMAP = pa.schema([("segment", pa.int32()), ("bits", pa.binary())])
_SUSPECTS = pa.schema([("id", pa.int64()), ("digest", pa.binary())])


def line_key(line: bytes) -> bytes:
    """A line without blanks at its ends, A-Z lower-cased (bytes.lower leaves all other letters)."""
    return line.strip(BLANKS).lower()


def long_keys(text: str, least_chars: int) -> set[bytes]:
    """The distinct keys of a text that have at least so many code points."""
    found = set()
    for line in text.encode().split(b"\n"):
        key = line_key(line)
        if len(key) >= least_chars and (len(key) >= 4 * least_chars or len(key.decode()) >= least_chars):
            found.add(key)
    return found


def probes(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each 64-bit hash, and its bit positions there (one row per hash)."""
    segment = (hashes >> np.uint64(40)) % np.uint64(segments)
    low = hashes & np.uint64((1 << 40) - 1)
    step = np.uint64(SEGMENT_BITS - 1)
    bits = np.stack([(low >> np.uint64(s)) * np.uint64(2 * s + 1) & step for s in range(0, 4 * PROBES, 4)], axis=1)
    return segment.astype(np.int32), bits.astype(np.int64)


def _hashes(keys: set[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def _task_filters(parts: Iterator[pa.RecordBatch], least_chars: int, segments: int) -> Iterator[pa.RecordBatch]:
    """The two filters of a task's documents, by segment."""
    held: dict[int, list[np.ndarray]] = {}
    for part in parts:
        found = [_hashes(long_keys(text, least_chars)) for text in part.column("text").to_pylist()]
        hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
        segment, bits = probes(hashes, segments)
        # a position counts once for each key, however many of the key's probes meet there
        spots = np.sort(bits, axis=1)
        fresh = np.ones(spots.shape, bool)
        fresh[:, 1:] = spots[:, 1:] != spots[:, :-1]
        flat = (segment[:, None].astype(np.int64) * SEGMENT_BITS + spots)[fresh]
        where, counts = np.unique(flat, return_counts=True)
        for s, lo, hi in _runs(where // SEGMENT_BITS):
            inside = (where[lo:hi] % SEGMENT_BITS).astype(np.uint32)
            _fold(held.setdefault(int(s), [np.zeros(0, np.uint32), np.zeros(0, np.uint32)]), inside, inside[counts[lo:hi] > 1])

    def rows() -> Iterator[tuple]:
        for s, (once, twice) in held.items():
            yield s, len(once) == SEGMENT_BITS // 8 and once.dtype == np.uint8, once.tobytes(), twice.tobytes()

    yield from batches(rows(), _FOLDED)
    give_back()


def _fold(pair: list[np.ndarray], seen: np.ndarray, again: np.ndarray) -> None:
    """Add positions to a segment's filters: distinct ones seen, and those of them seen more than once."""
    once, twice = pair
    if once.dtype == np.uint32 and 4 * (len(once) + len(seen)) > SEGMENT_BITS // 8:
        pair[:] = once, twice = _packed(once), _packed(twice)
    if once.dtype == np.uint8:
        there = (once[seen >> 3] >> (7 - (seen & 7)).astype(np.uint8) & 1).astype(bool)
        pair[0] = once | _packed(seen)
        pair[1] = twice | _packed(seen[there]) | _packed(again)
    else:
        pair[1] = np.unique(np.concatenate([twice, again, np.intersect1d(once, seen, assume_unique=True)]))
        pair[0] = np.union1d(once, seen)


def _packed(positions: np.ndarray) -> np.ndarray:
    bits = np.zeros(SEGMENT_BITS, bool)
    bits[positions] = True
    return np.packbits(bits)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of each run of equal values."""
    if len(values):
        starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        for lo, hi in zip(starts, np.r_[starts[1:], len(values)], strict=True):
            yield values[lo], int(lo), int(hi)


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by segment: one pass, one segment's two bitmaps held at a time."""
    nothing = np.zeros(SEGMENT_BITS // 8, np.uint8)

    def bitmap(given: bytes, is_packed: bool) -> np.ndarray:
        return np.frombuffer(given, np.uint8) if is_packed else _packed(np.frombuffer(given, np.uint32))

    def rows() -> Iterator[tuple]:
        held, once, twice = None, nothing, nothing
        for part in parts:
            for segment, is_packed, one, two in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if segment != held:
                    if held is not None:
                        yield held, twice.tobytes()
                    held, once, twice = segment, nothing, nothing
                seen = bitmap(one, is_packed)
                twice = twice | bitmap(two, is_packed) | (once & seen)
                once = once | seen
        if held is not None:
            yield held, twice.tobytes()

    yield from batches(rows(), _BITMAP)


def twice_filter(docs: DataFrame, least_chars: int, segments: int) -> np.ndarray:
    """The merged "twice" filter, one row of packed bits per segment; its size is ``segments`` alone."""
    spark = docs.sparkSession
    sets = docs.select(text_of(docs).alias("text")).mapInArrow(
        partial(_task_filters, least_chars=least_chars, segments=segments), "segment int, packed boolean, once binary, twice binary"
    )
    tasks = min(segments, partitions(spark))
    bitmaps = sets.repartition(tasks, "segment").sortWithinPartitions("segment").mapInArrow(_merged, "segment int, bits binary")
    whole = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
    for segment, bits in bitmaps.collect():
        whole[segment] = np.frombuffer(bits, np.uint8)
    return whole


def held_by(twice: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter holds."""
    segment, bits = probes(hashes, len(twice))
    return (twice[segment[:, None], bits >> 3] >> (7 - (bits & 7)).astype(np.uint8) & 1).all(axis=1)


def _digest(key: bytes) -> bytes:
    return hashlib.md5(key, usedforsecurity=False).digest()


def _suspects(parts: Iterator[pa.RecordBatch], least_chars: int, twice) -> Iterator[pa.RecordBatch]:
    held = twice.value

    def rows() -> Iterator[tuple]:
        for part in parts:
            for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                if keys := list(long_keys(text, least_chars)):
                    for i in np.flatnonzero(held_by(held, _hashes(keys))):
                        yield doc, _digest(keys[i])

    yield from batches(rows(), _SUSPECTS)
    give_back()


def _rebuilt(parts: Iterator[pa.RecordBatch], least_chars: int) -> Iterator[pa.RecordBatch]:
    for part in parts:
        texts, lines, dropped = [], [], []
        for text, drops in zip(part.column("text").to_pylist(), part.column("drops").to_pylist(), strict=True):
            own = text.encode().split(b"\n")
            kept = own
            if drops:
                gone = set(drops)
                kept = [x for x in own if len(k := line_key(x)) < least_chars or _digest(k) not in gone]
            texts.append(b"\n".join(kept).decode())
            lines.append(len(own))
            dropped.append(len(own) - len(kept))
        yield pa.record_batch(
            [part.column("row"), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
            names=["row", "text", "n_lines", "n_dropped"],
        )
    give_back()


def segments_for(docs: DataFrame, bits_per_line: int, most_bits: int) -> int:
    """Segments of a filter with so many bits for each line of the corpus, within the bound."""
    text = text_of(docs)
    lines = docs.select(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    wanted = min(most_bits, max(SEGMENT_BITS, lines * bits_per_line))
    return -(-wanted // SEGMENT_BITS)


def dedup_lines(
    docs: DataFrame,
    least_chars: int = 20,
    least_docs: int = 3,
    bits_per_line: int = 12,
    most_bits: int = 1 << 28,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Drop repeated lines everywhere but in the last document that holds them.

    A line's key is the line without blanks at both ends, A-Z lower-cased.  Keys of ``least_chars`` code points or
    more that occur in ``least_docs`` documents or more lose all their lines except in the largest document id that
    holds them; there all of them stay.  The result has the columns of ``docs`` with the new text, then ``n_lines``
    (before) and ``n_dropped``; columns of these names are replaced.

    Null texts are one empty line.  Rows with one id are one document.  Rows with a null id are one document,
    counted before all others.  An empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(text).alias("text"))
    segments = segments_for(texts, bits_per_line, most_bits)
    twice = docs.sparkSession.sparkContext.broadcast(twice_filter(texts, least_chars, segments))
    ids = F.col(doc_id).cast("long")
    suspects = docs.select(ids.alias("id"), text_of(docs, text).alias("text")).mapInArrow(
        partial(_suspects, least_chars=least_chars, twice=twice), "id long, digest binary"
    )
    drops = cut(_drops(suspects, least_docs))
    losing = docs.sparkSession.sparkContext.broadcast(filter_of(drops.select("id")))
    rows = packed(docs, id=ids, text=text_of(docs, text)).withColumn("touched", _touched(losing)(F.col("id")))
    whole = rows.where("touched").join(drops.withColumnRenamed("id", "drop_id"), F.expr("id <=> drop_id"), "left")
    shape = StructType([whole.schema["row"]]).add("text", "string").add("n_lines", "long").add("n_dropped", "long")
    rebuilt = whole.select("row", "text", "drops").mapInArrow(partial(_rebuilt, least_chars=least_chars), shape)
    lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    passed = rows.where(~F.col("touched")).select("row", "text", lines.cast("long"), F.lit(0).cast("long"))
    return unpacked(
        rebuilt.union(passed), docs.columns, **{text: F.col("text"), "n_lines": F.col("n_lines"), "n_dropped": F.col("n_dropped")}
    )


def _touched(losing) -> Callable[[Column], Column]:
    """Whether the filter may hold an id; ids alone go to Python, texts stay where they are."""

    @F.arrow_udf("boolean")
    def touched(ids: pa.Array) -> pa.Array:
        return pa.array(may_hold(losing.value, ids))

    return touched


def _drops(suspects: DataFrame, least_docs: int) -> DataFrame:
    """(id, drops): the digests that each document has to lose.  Counts are exact; hot digests are counted before
    they travel, and a join on a hot digest is split by Spark (skew join)."""
    held = suspects.distinct()
    confirmed = (
        held.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("keeper"))
        .where(F.col("docs") >= least_docs)
        .select("digest", "keeper")
    )
    away: Column = ~F.col("id").eqNullSafe(F.col("keeper"))
    return held.join(confirmed, "digest").where(away).groupBy("id").agg(F.collect_list("digest").alias("drops"))
