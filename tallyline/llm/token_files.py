"""Token-id files: canonical length-limited Huffman codes from global counts.

A set of token files is a folder with two Parquet tables:

``code``    one row: the code length of every id (0: not used), one byte each.  Codes are canonical: ordered by length,
            then id, so the lengths are the whole code.
``blocks``  one row for each block of whole documents: its part and number there (their order is the document order),
            the documents' ids and sizes, the number of tokens before the block in its part, the bits, and the bit
            offset of every ``STRIDE``-th token.

A block can be read alone.  Its checkpoints let a reader decode many stretches side by side: one table lookup for each
stretch and step gives the next id and its code length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.bpe import encoded_by
from tallyline.llm.common import batches, cut, give_back, partitions, release

LONGEST = 16
STRIDE = 512
_BLOCK_TOKENS = 1 << 20
_STRETCH = 64 * STRIDE
_BLOCKS = pa.schema(
    [
        ("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()),
        ("docs", pa.binary()), ("missing", pa.binary()), ("sizes", pa.binary()), ("bits", pa.binary()), ("checkpoints", pa.binary()),
    ]
)
_SHRUNK_SQL = "doc long, data binary, counts binary"
_SHRUNK = pa.schema([("doc", pa.int64()), ("data", pa.binary()), ("counts", pa.binary())])
_BLOCKS_SQL = "part int, block int, before long, n_tokens long, docs binary, missing binary, sizes binary, bits binary, checkpoints binary"


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of an optimal prefix code with no code over ``longest`` bits (package-merge); 0 for unused ids."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids do not fit codes of {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    level, kinds = weights, []
    for _ in range(longest - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([weights, pairs])
        place = np.argsort(merged, kind="stable")
        kinds.append(place < len(weights))
        level = merged[place]
    taken, own = 2 * len(used) - 2, np.zeros(len(used), np.uint8)
    for single in reversed(kinds):
        singles = int(single[:taken].sum())
        own[:singles] += 1
        taken = 2 * (taken - singles)
    own[:taken] += 1
    lengths[order] = own
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes by id, and the lookup from the next ``LONGEST`` bits to an id and its length."""
    ids = np.lexsort((np.arange(len(lengths)), lengths))
    ids = ids[lengths[ids] > 0]
    spans = 1 << (LONGEST - lengths[ids].astype(np.int64))
    starts = np.cumsum(spans) - spans
    codes = np.zeros(len(lengths), np.uint64)
    codes[ids] = starts >> (LONGEST - lengths[ids].astype(np.int64))
    to_id = np.zeros(1 << LONGEST, np.int32)
    to_length = np.ones(1 << LONGEST, np.int64)
    total = int(spans.sum())
    to_id[:total] = np.repeat(ids, spans)
    to_length[:total] = np.repeat(lengths[ids], spans)
    return codes, to_id, to_length


def pack_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of some ids, and the bit offset of every ``STRIDE``-th id."""
    room = np.zeros(len(ids) * LONGEST // 32 + 2, np.uint64)
    checkpoints, total = [], 0
    for lo in range(0, len(ids), _STRETCH):  # stretches that stay in the processor's cache
        some = ids[lo : lo + _STRETCH]
        size = lengths[some].astype(np.int64)
        ends = np.cumsum(size) + total
        at = ends - size
        window = codes[some] << (64 - (at & 31) - size).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        here = word[first]
        room[here] |= np.bitwise_or.reduceat(window >> np.uint64(32), first)
        room[here + 1] |= np.bitwise_or.reduceat(window & np.uint64(0xFFFFFFFF), first)
        checkpoints.append(at[::STRIDE].copy())
        total = int(ends[-1])
    return room[: total // 32 + 2].astype(">u4").tobytes(), np.concatenate(checkpoints)


def unpack_bits(bits: bytes, checkpoints: np.ndarray, total: int, to_id: np.ndarray, to_length: np.ndarray) -> np.ndarray:
    """The ids of a block: all stretches between checkpoints advance side by side."""
    data = np.frombuffer(bits + b"\0\0\0", np.uint8).astype(np.int64)
    at = checkpoints.astype(np.int64)
    out = np.zeros((len(at), STRIDE), np.int32)
    for step in range(STRIDE):
        byte = np.minimum(at >> 3, len(data) - 3)
        window = (data[byte] << 16 | data[byte + 1] << 8 | data[byte + 2]) >> (8 - (at & 7)) & 0xFFFF
        out[:, step] = to_id[window]
        at = at + to_length[window]
    return out.ravel()[:total]


def _shrunk(parts: Iterator[pa.RecordBatch], end_id: int) -> Iterator[pa.RecordBatch]:
    """Each document's ids and the end id as small bytes, and a last row with how often each id was met."""
    pack = zstandard.ZstdCompressor(level=1).compress
    counts = np.zeros(end_id + 1, np.int64)

    def rows() -> Iterator[tuple]:
        nonlocal counts
        for part in parts:
            lists = part.column(1)
            flat, edges = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            found = np.bincount(flat[edges[0] : edges[-1]], minlength=len(counts))
            found[: len(counts)] += counts
            found[end_id] += part.num_rows
            counts = found
            for i, doc in enumerate(part.column(0).to_pylist()):
                ids = np.append(flat[edges[i] : edges[i + 1]], np.int32(end_id))
                yield doc, pack(_planes(ids)), None
        if counts.any():
            yield None, None, pack(counts.tobytes())

    yield from batches(rows(), _SHRUNK)
    give_back()


def _planes(ids: np.ndarray) -> bytes:
    """Ids by bytes, low bytes first: two planes, or four where an id needs them."""
    wide = 2 if ids.max() <= 0xFFFF else 4
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T[:wide]
    return bytes([wide]) + planes.tobytes()


def _whole(data: bytes, unpack) -> np.ndarray:
    plain = np.frombuffer(unpack(data), np.uint8)
    planes = plain[1:].reshape(int(plain[0]), -1)
    out = np.zeros((planes.shape[1], 4), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view("<u4").ravel().astype(np.int32)


def _counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    counts = np.zeros(0, np.int64)
    for part in parts:
        for data in part.column("counts").to_pylist():
            found = np.frombuffer(unpack(data), np.int64).copy()
            if len(found) < len(counts):
                counts, found = found, counts
            found[: len(counts)] += counts
            counts = found
    used = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(used, pa.int32()), pa.array(counts[used])], names=["id", "n"])


def id_counts(shrunk: DataFrame, end_id: int) -> np.ndarray:
    """How often each id occurs.  The result is as long as the vocabulary, no longer."""
    parts = shrunk.where("counts IS NOT NULL").select("counts")
    summed = parts.mapInArrow(_counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = {row["id"]: row["n"] for row in summed.collect()}
    counts = np.zeros(max([end_id, *found]) + 1, np.int64)
    for i, n in found.items():
        counts[i] = n
    return counts


def _packed(parts: Iterator[pa.RecordBatch], lengths: Broadcast) -> Iterator[pa.RecordBatch]:
    sizes = np.frombuffer(lengths.value, np.uint8)
    codes, _, _ = canonical(sizes)
    unpack = zstandard.ZstdDecompressor().decompress

    def rows() -> Iterator[tuple]:
        part_no, block, before = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        counts: list[int] = []
        held: list[np.ndarray] = []
        size = 0
        for part in parts:
            for doc, data in zip(part.column("doc").to_pylist(), part.column("data").to_pylist(), strict=True):
                ids = _whole(data, unpack)
                docs.append(doc)
                counts.append(len(ids))
                held.append(ids)
                size += len(ids)
                if size >= _BLOCK_TOKENS:
                    yield one(part_no, block, before, docs, counts, held)
                    block, before, docs, counts, held, size = block + 1, before + size, [], [], [], 0
        if docs:
            yield one(part_no, block, before, docs, counts, held)

    def one(part_no: int, block: int, before: int, docs: list, counts: list, held: list) -> tuple:
        ids = np.concatenate(held)
        bits, checkpoints = pack_bits(ids, sizes, codes)
        names = np.array([0 if d is None else d for d in docs], np.int64)
        missing = np.array([d is None for d in docs], bool)
        return (
            part_no, block, before, len(ids), names.tobytes(), missing.tobytes(),
            np.array(counts, np.int64).tobytes(), bits, checkpoints.tobytes(),
        )

    yield from batches(rows(), _BLOCKS)


def write_token_files(encoded: DataFrame, folder: str, end_id: int = 1, doc_id: str = "doc_id") -> None:
    """Write (doc_id, ids array<int>) as token files, the end id after each document, in ascending document id.

    Null ids come first; rows with one id stand in a fixed order of their contents.  Documents without ids hold the end id alone.
    """
    rows = encoded.select(F.col(doc_id).alias("doc"), "ids")
    _write(cut(rows.mapInArrow(partial(_shrunk, end_id=end_id), _SHRUNK_SQL)), folder, end_id)


def write_texts(docs: DataFrame, folder: str, end_id: int = 1, path: str | None = None) -> None:
    """Encode whole texts (``doc_id``, ``text``) and write them as token files, as :func:`write_token_files` does."""
    step = partial(_shrunk, end_id=end_id)
    _write(cut(encoded_by(docs, path, "doc_id", "text", step, _SHRUNK_SQL, keep=True)), folder, end_id)


def _write(shrunk: DataFrame, folder: str, end_id: int) -> None:
    spark = shrunk.sparkSession
    release(spark)  # what the encoding shuffled and kept is not needed any more
    lengths = code_lengths(id_counts(shrunk, end_id))
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{folder}/code")
    code = spark.sparkContext.broadcast(lengths.tobytes())
    documents = shrunk.where("data IS NOT NULL").select("doc", "data")
    ordered = documents.repartitionByRange(partitions(spark), "doc").sortWithinPartitions("doc", "data")
    ordered.mapInArrow(partial(_packed, lengths=code), _BLOCKS_SQL).write.parquet(f"{folder}/blocks")


def _read(parts: Iterator[pa.RecordBatch], lengths: Broadcast, with_ids: bool) -> Iterator[pa.RecordBatch]:
    _, to_id, to_length = canonical(np.frombuffer(lengths.value, np.uint8))
    for part in parts:
        for row in part.to_pylist():
            ids = unpack_bits(row["bits"], np.frombuffer(row["checkpoints"], np.int64), row["n_tokens"], to_id, to_length)
            sizes = np.frombuffer(row["sizes"], np.int64)
            docs = pa.array(np.frombuffer(row["docs"], np.int64), mask=np.frombuffer(row["missing"], bool))
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            starts = row["start"] + offsets[:-1]
            whole = ids.astype("<u4")
            crcs = [zlib.crc32(whole[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            columns = {"doc_id": docs, "start": pa.array(starts), "n_tokens": pa.array(sizes), "ids_crc32": pa.array(crcs, pa.int64())}
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document in token files.

    ``start`` is the number of ids before the document, ``ids`` holds the end id, ``ids_crc32`` is the CRC-32 of the
    ids as little-endian unsigned 32-bit integers.  Without ``with_ids`` the ids are read but not returned.
    """
    blocks = spark.read.schema(_BLOCKS_SQL).parquet(f"{folder}/blocks")
    lengths = spark.read.schema("lengths binary").parquet(f"{folder}/code").first()
    code = spark.sparkContext.broadcast(bytes(lengths[0]))
    # one row for each written part, so that the running sum over them is small whatever the corpus
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select(F.col("part").alias("of"), F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    placed = blocks.join(base, F.col("part") == F.col("of")).withColumn("start", F.col("base") + F.col("before"))
    return placed.select("start", "n_tokens", "docs", "missing", "sizes", "bits", "checkpoints").mapInArrow(
        partial(_read, lengths=code, with_ids=with_ids),
        "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""),
    )
