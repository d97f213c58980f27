"""BPE encoding through a table of distinct words, and decoding through a table of pieces.

The tokenizer never merges across white space, so a text's ids are its words' ids in order.

1. Documents are split into words in blocks of bounded text.  A block keeps, for each document, the numbers of its
   words, and a list of its distinct words, dealt into buckets by hash.
2. Each bucket sees every word of its hash once per block, keeps one table of distinct words and encodes each word
   once, with the tokenizer itself.
3. The ids go back to the blocks, where the word numbers turn into ids by position.  Word numbers are made in a
   second pass over the documents, which costs less than keeping them meanwhile.

A frequent word travels once per block, whatever its count, so no word is hot.  Words are cut at ASCII white space;
other white space stays inside a word, where the tokenizer itself cuts.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import partial
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from tokenizers import Tokenizer

from tallyline.llm.common import batches, cut, give_back, partitions, small_batches, text_of

WORD_BPE = "word_bpe_49k.json"
#: Text of one block, and of all blocks together for each bucket: what a Python worker holds grows with these.
_BLOCK_BYTES = 12 << 20
_BUCKET_BYTES = 8 << 20
_AT_ONCE = 1 << 17
_STRETCH = 1 << 18
_SPLIT = pa.schema(
    [("block", pa.int64()), ("bucket", pa.int32()), ("docs", pa.binary()), ("missing", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary()), ("buckets", pa.binary())]
)
_SPLIT_SQL = "block long, bucket int, docs binary, missing binary, sizes binary, data binary, buckets binary"


def default_path() -> str:
    return public_tokenizers.path(WORD_BPE)


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


#: Punctuation that ends words; a word goes to the bucket of what stands before it, where its pieces are met again.
_ENDS = ".,;:!?&%#*$"
#: Letters and numbers below U+0250 that the tokenizer's normaliser only lower-cases, one code point to one.
_LETTERS = "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == "L" and len(c.lower()) == 1)
_NUMBERS = "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == "N")
_PLAIN = re.compile(f"[\x21-\x7e\xa1-\xbf{_LETTERS}]*")
#: The tokenizer's own cut into pieces, for plain words.
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")


class WordEncoder:
    """Ids of words.  Plain words are cut into pieces here, and each piece is encoded once; all others, and words that
    may hold a special token, go through the library whole."""

    def __init__(self, content: str) -> None:
        self.whole = load_tokenizer(content)
        model = json.loads(content)
        self.plain = _cuts_as_here(model)
        # pieces are normalised and cut already
        model |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": _BYTES}
        self.pieces = Tokenizer.from_str(json.dumps(model))

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids one after another)."""
        numbers: dict[str, int] = {}
        plan: list[list[int]] = []
        odd: list[str] = []
        for word in words:
            if self.plain and "<|" not in word and _PLAIN.fullmatch(word):
                plan.append([numbers.setdefault(p, len(numbers)) for p in _PIECE.findall(word.lower())])
            else:
                plan.append([-1 - len(odd)])
                odd.append(word)
        parts = [self._ids(self.pieces, list(numbers)), self._ids(self.whole, odd)]
        counts = np.fromiter(map(len, plan), np.int64, len(plan))
        flat = np.fromiter(chain.from_iterable(plan), np.int64, int(counts.sum()))
        flat = np.where(flat < 0, len(numbers) - 1 - flat, flat)
        lengths, ids = (np.concatenate([p[i] for p in parts]) for i in range(2))
        starts = np.cumsum(lengths) - lengths
        ends = np.concatenate([[0], np.cumsum(lengths[flat])])
        edges = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(ends[edges]), _gathered(flat, lengths, starts, ids)

    @staticmethod
    def _ids(tokenizer: Tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for lo in range(0, len(texts), 4096):
            own = [e.ids for e in tokenizer.encode_batch_fast(texts[lo : lo + 4096], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, own), np.int64, len(own)))
            ids.append(np.fromiter(chain.from_iterable(own), np.int32, int(sizes[-1].sum())))
        return np.concatenate(sizes), np.concatenate(ids)


@functools.lru_cache(maxsize=1)
def load_encoder(content: str) -> WordEncoder:
    return WordEncoder(content)


_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def _cuts_as_here(model: dict) -> bool:
    """Whether a tokenizer file normalises and cuts in the way that ``_PIECE`` repeats for plain words."""
    normal = [n.get("type") for n in (model.get("normalizer") or {}).get("normalizers", [])]
    cut = (model.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    return normal == ["NFC", "Replace", "Lowercase"] and cut.get("pattern") == {"Regex": pattern} and cut.get("invert") is True


def _steps(part: dict | None, inner: str) -> list[dict]:
    return [] if not part else part[inner] if part.get("type") == "Sequence" else [part]


def known_tokenizer(path: str | None) -> str:
    """A tokenizer file's content; a file whose words cannot be encoded one by one is refused.

    White space has to part words and be dropped (the given file's cut, or ``Whitespace`` and ``WhitespaceSplit``), no
    normaliser or added token may reach over it, and decoding has to join pieces with a space (no decoder).
    """
    content = read_tokenizer(path or default_path())
    file = json.loads(content)
    first = (_steps(file.get("pre_tokenizer"), "pretokenizers") or [{}])[0].get("type")
    plain = all(n.get("type") in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") for n in _steps(file.get("normalizer"), "normalizers"))
    added = all(not t["content"].split()[1:] and t["content"] == t["content"].strip() for t in file.get("added_tokens", []))
    if not (_cuts_as_here(file) or plain and first in ("Whitespace", "WhitespaceSplit")) or not added or file.get("decoder"):
        raise ValueError(f"{path}: words of this tokenizer are not encoded and decoded one by one")
    return content


@functools.lru_cache(maxsize=2)
def load_tokenizer(content: str) -> Tokenizer:
    tokenizer = Tokenizer.from_str(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def shrink(values: np.ndarray) -> bytes:
    """Numbers below 2 ** 28 in seven bits a byte, the last byte of each marked, compressed."""
    plain = b"".join(_marked(values[lo : lo + _STRETCH].astype(np.uint32)) for lo in range(0, len(values), _STRETCH))
    return zstandard.ZstdCompressor(level=1).compress(plain)


def _marked(values: np.ndarray) -> bytes:
    sizes = 1 + (values >= 1 << 7) + (values >= 1 << 14) + (values >= 1 << 21)
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for step in range(4):
        here = sizes > step
        out[ends[here] - 1 - step] = values[here] >> np.uint32(7 * step) & np.uint32(127)
    out[ends - 1] |= 128
    return out.tobytes()


def grow(data: bytes) -> np.ndarray:
    plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    found, lo = [np.zeros(0, np.int32)], 0
    while lo < len(plain):
        hi = min(len(plain), lo + _STRETCH)
        while not plain[hi - 1] & 128:  # a number's last byte ends a stretch
            hi += 1
        found.append(_unmarked(plain[lo:hi]))
        lo = hi
    return np.concatenate(found)


def _unmarked(plain: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(plain & 128)
    sizes = np.diff(np.append(-1, ends))
    values = np.zeros(len(ends), np.int32)
    for step in range(4):
        here = sizes > step
        values[here] |= (plain[ends[here] - step] & 127).astype(np.int32) << 7 * step
    return values


def _text_bytes(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, bytes) of the words of an array, one after another."""
    _, offsets, data = words.buffers()
    edges = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return np.diff(edges), whole[edges[0] : edges[-1]] if len(edges) else whole


def _text_array(sizes: np.ndarray, data: bytes) -> pa.StringArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))


def bucket_of(words: pa.StringArray, buckets: int) -> np.ndarray:
    """A bucket for each word from a polynomial hash of its bytes, the same in every block."""
    sizes, data = _text_bytes(words)
    powers = np.cumprod(np.full(max(1, int(sizes.max(initial=0))), 0x9E3779B97F4A7C15, np.uint64))
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[place])])
    mixed = total[starts + sizes] - total[starts]
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _split(parts: Iterator[pa.RecordBatch], buckets: int, words: bool, numbers: bool) -> Iterator[pa.RecordBatch]:
    """For each block, a row for each of its buckets of words, and one row of word numbers (bucket -1)."""

    def rows() -> Iterator[tuple]:
        size = 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.StringArray]] = []
        for part in parts:
            lists = pc.ascii_split_whitespace(part.column("text"))
            docs = part.column("id")
            sizes = pc.list_value_length(lists).to_numpy()
            missing = docs.is_null().to_numpy(zero_copy_only=False)
            held.append((docs.fill_null(0).to_numpy(), missing, sizes, lists.flatten()))
            size += part.column("text").nbytes
            if size >= _BLOCK_BYTES:
                yield from _block_rows(held, buckets, words, numbers)
                size, held = 0, []
        if held:
            yield from _block_rows(held, buckets, words, numbers)

    yield from batches(rows(), _SPLIT)
    give_back()


def _block_rows(held: list[tuple], buckets: int, with_words: bool, with_numbers: bool) -> Iterator[tuple]:
    """Words are numbered by frequency; a bucket lists its words in that order.

    A block is named by its contents, so that its words and its word numbers can be made in two passes.
    """
    docs, missing, sizes = (np.concatenate([h[i] for h in held]) for i in range(3))
    numbered = pa.chunked_array([h[3] for h in held], pa.string()).dictionary_encode().combine_chunks()
    held.clear()
    words, flat = numbered.dictionary, numbered.indices.to_numpy()
    order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.int32)
    rank[order] = np.arange(len(words), dtype=np.int32)
    stems = pc.utf8_rtrim(pc.utf8_lower(words), characters=_ENDS)
    bucket = bucket_of(stems, buckets)[order]
    mark = xxhash.xxh3_64(_text_bytes(words)[1].tobytes())
    for part in (docs.astype(np.int64), missing, sizes, flat):
        mark.update(np.ascontiguousarray(part).view(np.uint8))
    block = mark.intdigest() >> 1
    if with_numbers:
        yield block, -1, docs.astype(np.int64).tobytes(), missing.tobytes(), shrink(sizes), shrink(rank[flat]), shrink(bucket)
    if not with_words:
        return
    by_bucket = np.argsort(bucket, kind="stable")
    lengths, data = _text_bytes(words.take(pa.array(order[by_bucket])))
    edges = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
    at = np.concatenate([[0], np.cumsum(lengths)])
    pack = zstandard.ZstdCompressor(level=3).compress
    for b in range(buckets):
        lo, hi = edges[b], edges[b + 1]
        if lo < hi:
            yield block, b, None, None, shrink(lengths[lo:hi]), pack(data[at[lo] : at[hi]].tobytes()), None


def _gathered(numbers: np.ndarray, lengths: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The ids of some words, one word after another."""
    counts = lengths[numbers]
    total = np.cumsum(counts, dtype=np.int64)
    return ids[np.repeat(starts[numbers] - total + counts, counts) + np.arange(int(total[-1]) if len(total) else 0)]


def _encoded(parts: Iterator[pa.RecordBatch], content: Broadcast) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: words become ids; each distinct word of a bucket is encoded once."""
    encoder = load_encoder(content.value)

    def rows() -> Iterator[tuple]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: int | None = None
        blocks: list[int] = []
        words: list[pa.StringArray] = []
        for part in parts:
            columns = (part.column(n).to_pylist() for n in ("block", "bucket", "sizes", "data"))
            for block, bucket, sizes, data in zip(*columns, strict=True):
                if bucket != held:
                    if blocks:
                        yield from finished(held, blocks, words)
                    held, blocks, words = bucket, [], []
                blocks.append(block)
                words.append(_text_array(grow(sizes), unpack(data)))
        if blocks:
            yield from finished(held, blocks, words)

    def finished(bucket: int, blocks: list[int], words: list[pa.StringArray]) -> Iterator[tuple]:
        numbered = pa.chunked_array(words, pa.string()).dictionary_encode()
        distinct = numbered.chunk(0).dictionary
        lengths, flat = encoder.encode(distinct.to_pylist())
        starts = np.cumsum(lengths) - lengths
        for block, chunk in zip(blocks, numbered.chunks, strict=True):
            own = chunk.indices.to_numpy()
            yield block, bucket, None, None, shrink(lengths[own]), shrink(_gathered(own, lengths, starts, flat)), None

    yield from batches(rows(), _SPLIT)
    give_back()


def _joined(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and bucket: word numbers become ids by position."""
    held: list[tuple] = []  # equal blocks have one name; each gives its documents
    name, last, sizes, ids = None, -1, [], []

    def finished() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        by_bucket = np.concatenate([*sizes, np.zeros(0, np.int32)])
        order = np.argsort(held[0][4], kind="stable")
        if len(order) != len(by_bucket):
            raise ValueError("the documents changed while they were read: cut the frame first")
        lengths, starts = np.empty_like(by_bucket), np.empty(len(by_bucket), np.int64)
        lengths[order] = by_bucket
        starts[order] = np.cumsum(by_bucket, dtype=np.int64) - by_bucket
        flat = np.concatenate([*ids, np.zeros(0, np.int32)])
        for docs, missing, words, numbers, _ in held:
            yield from _documents(docs, missing, words, numbers, lengths, starts, flat)

    for part in parts:
        columns = (c.to_pylist() for c in part.columns)
        for block, bucket, docs, missing, own, data, buckets in zip(*columns, strict=True):
            if block != name:
                yield from finished()
                held, name, last, sizes, ids = [], block, -1, [], []
            if bucket == -1:
                held.append((np.frombuffer(docs, np.int64), np.frombuffer(missing, bool), grow(own), grow(data), grow(buckets)))
            elif bucket != last:
                last = bucket
                sizes.append(grow(own))
                ids.append(grow(data))
    yield from finished()
    held, sizes, ids = [], [], []
    give_back()


def _documents(
    docs: np.ndarray,
    missing: np.ndarray,
    sizes: np.ndarray,
    flat: np.ndarray,
    lengths: np.ndarray,
    starts: np.ndarray,
    ids: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """Batches of (id, ids) for some documents at a time."""
    ends = np.cumsum(sizes, dtype=np.int64)
    lo = 0
    while lo < len(docs):
        first = ends[lo] - sizes[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, first + _AT_ONCE, "right")))
        words = flat[first : ends[hi - 1]]
        total = np.concatenate([[0], np.cumsum(lengths[words], dtype=np.int64)])
        offsets = total[np.concatenate([[0], ends[lo:hi] - first])]
        values = pa.array(_gathered(words, lengths, starts, ids))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
        yield pa.record_batch([pa.array(docs[lo:hi], mask=missing[lo:hi]), lists], names=["id", "ids"])
        lo = hi


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def encoded_by(
    docs: DataFrame, path: str | None, doc_id: str, text: str, step: Step, schema: str, keep: bool = False
) -> DataFrame:
    """What ``step`` makes of (id, ids), in the tasks that put the ids together: one Python worker does both.

    With ``keep`` the word numbers are kept in the shared folder between the two uses, else they are made twice: that
    is disk against time.
    """
    spark = docs.sparkSession
    small_batches(spark)
    content = spark.sparkContext.broadcast(known_tokenizer(path))
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), text_of(docs, text).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(1 << 20, max(8, size // _BUCKET_BYTES)))
    if keep:
        both = cut(texts.mapInArrow(partial(_split, buckets=buckets, words=True, numbers=True), _SPLIT_SQL))
        words, numbers = both.where("bucket >= 0"), both.where("bucket < 0")
    else:
        words = texts.mapInArrow(partial(_split, buckets=buckets, words=True, numbers=False), _SPLIT_SQL)
        numbers = texts.mapInArrow(partial(_split, buckets=buckets, words=False, numbers=True), _SPLIT_SQL)
    words = words.repartition(max(buckets, partitions(spark)), "bucket")
    encoded = words.sortWithinPartitions("bucket").mapInArrow(partial(_encoded, content=content), _SPLIT_SQL)
    together = numbers.unionByName(encoded).repartition(max(buckets, partitions(spark)), "block")
    ordered = together.sortWithinPartitions("block", "bucket")
    return ordered.mapInArrow(lambda parts: step(_joined(parts)), schema)


def encode(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for every row: the ids that the tokenizer file gives the whole text.

    No special tokens are added; strings of special tokens inside a text are those tokens, as the library has it.
    Null texts are empty; empty texts have no ids.  Repeated rows and null ids stay as they are, one result row for
    each row.  Other columns are not kept.  The documents are read twice: a frame that may give other rows or another
    order the second time has to be cut before; a block that changed between the passes ends the job with an error.
    """
    found = encoded_by(docs, path, doc_id, text, lambda parts: parts, "id long, ids array<int>")
    return found.select(F.col("id").alias(doc_id), "ids")


def encode_and_decode(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) for every row: :func:`encode`, then :func:`decode`, without a stop between them."""
    pieces = docs.sparkSession.sparkContext.broadcast(_pieces(path))
    step = partial(_decoded, at=1, pieces=pieces)
    found = encoded_by(docs, path, doc_id, text, step, "id long, ids array<int>, __decoded string")
    return found.select(F.col("id").alias(doc_id), "ids", F.col("__decoded").alias("decoded"))


def _pieces(path: str | None) -> list[str]:
    tokenizer = load_tokenizer(known_tokenizer(path))
    return [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]


def _decoded(parts: Iterator[pa.RecordBatch], at: int, pieces: Broadcast) -> Iterator[pa.RecordBatch]:
    table = pa.array(pieces.value, pa.string())
    for part in parts:
        lists = part.column(at)
        flat = lists.flatten()  # without the values of null lists
        known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(table)))
        found = pc.take(table, pc.if_else(known, flat, None))
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        if found.null_count:  # ids that the vocabulary does not have are left out
            there = found.is_valid().to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(there)])[offsets]
            found = found.drop_null()
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found), " ")
        yield pa.record_batch([*part.columns, texts], names=[*part.schema.names, "__decoded"])


def decode(frame: DataFrame, path: str | None = None, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The frame with the text of its ids in column ``into``: ids join the table of pieces, pieces join with a space.

    The table of pieces is one vocabulary, so it is broadcast, and the join is a lookup by position.  Special tokens
    are kept.  Ids the vocabulary does not have and null ids are left out; a null list gives an empty text.
    """
    pieces = frame.sparkSession.sparkContext.broadcast(_pieces(path))
    names = [c for c in frame.columns if c != into]
    kept = frame.select(*names)
    schema = StructType([*kept.schema.fields, StructField("__decoded", StringType())])
    decoded = kept.mapInArrow(partial(_decoded, at=names.index(ids), pieces=pieces), schema)
    return decoded.select(*names, F.col("__decoded").alias(into))
