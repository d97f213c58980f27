"""Benchmark decontamination by latent semantic retrieval.

1. The benchmark's words are the vocabulary.  Documents become arrays of vocabulary numbers (0: any other word), kept
   once in the shared folder.  Passages are 48 words.
2. Passage frequencies of the vocabulary over all documents give the inverse document frequencies.  Words in over
   ``common`` of all passages weigh nothing, unless a benchmark passage would be left with almost no weight.
3. A randomised SVD of the TF-IDF passages: every task multiplies its passages with one random matrix and back
   (``A' (A R)``), the products are added up, and the small rest (Nystroem form) gives the leading right singular
   vectors.  All passages of all documents take part.
4. Every benchmark item is cut into passages of at most 32 words, of which one is enough to find it.  Windows of 48 words, one every 16 words of every
   document, are compared with them by the cosine in the latent space; pairs above a low cosine are candidates.
   A cosine falls short of some copies whatever its bound, the more the larger the benchmark.  So there is a second,
   exact source: where the check of step 5 can succeed, at most ``1 - reworded`` of some passage's words are missing, so
   of that many and ``shared`` more of its rarest words at least ``shared`` stand in the stretch that is aligned.  All
   stretches with so many are candidates too.
5. A candidate's words are aligned with the item's by their longest common subsequence, found bit-parallel for many
   candidates at once.  An item whose words are nearly all there is a copy; one with fewer words there counts as a
   paraphrase only if its answer, the last sentence, is there too.

A document is one row, so steps 4 and 5 need no shuffle.  The benchmark is broadcast in blocks of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import batches, cut, give_back, packed, partitions, small_batches, text_of, unpacked

#: Every ASCII character that is no letter, digit or underscore ends a word.
_GAPS = bytes(b if b > 127 or chr(b).isalnum() or b == 95 else 32 for b in range(256))
_SENTENCE = re.compile(r"[.?!\n]+")
_SEGMENT = 1 << 16
_BAND = 256
_SPREAD = 16
_WORDS = pa.schema([("id", pa.int64()), ("words", pa.binary())])
_SUMS = pa.schema([("band", pa.int32()), ("data", pa.binary())])
_HITS_SQL = "id long, item_id long, cosine double, lcs double, answer double"


@dataclass(frozen=True)
class Settings:
    """``copied``: share of an item's words, in order, that makes a copy; ``reworded``: that makes a paraphrase if
    ``answered`` of the answer's words are there too; ``short``: words under which a passage's words must stand close
    together to make a candidate."""

    terms: int = 1 << 15
    rank: int = 96
    common: float = 0.02
    least_weighted: int = 5
    balance: float = 0.25
    chunk: int = 16
    chunks: int = 3
    item_words: int = 32
    cosine: float = 0.3
    shared: int = 4
    short: int = 8
    copied: float = 0.8
    reworded: float = 0.65
    answered: float = 0.8
    passages_at_once: int = 1 << 14

    @property
    def window(self) -> int:
        return self.chunk * self.chunks


class _Known(dict[bytes, int]):
    """Vocabulary numbers; 0 for every word that is not in it."""

    def __missing__(self, word: bytes) -> int:
        return 0


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_GAPS).split()


def _numbered(parts: Iterator[pa.RecordBatch], vocabulary: Broadcast) -> Iterator[pa.RecordBatch]:
    known, pack = _Known(vocabulary.value), zstandard.ZstdCompressor(level=1).compress

    def rows() -> Iterator[tuple]:
        for part in parts:
            for doc, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                words = words_of(text)
                yield doc, pack(np.fromiter(map(known.__getitem__, words), np.int32, len(words)).tobytes())

    yield from batches(rows(), _WORDS)
    give_back()


def _segments(parts: Iterator[pa.RecordBatch], overlap: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, row number, words) of every document; very long ones in stretches that overlap."""
    unpack, row = zstandard.ZstdDecompressor().decompress, 0
    for part in parts:
        for doc, data in zip(part.column("id").to_pylist(), part.column("words").to_pylist(), strict=True):
            words = np.frombuffer(unpack(data), np.int32)
            for at in range(0, max(1, len(words) - overlap), _SEGMENT):
                yield doc, row, words[at : at + _SEGMENT + overlap]
            row += 1


def _stretches(parts: Iterator[pa.RecordBatch], overlap: int, ids: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Some documents' words side by side: (words, first word of each document, its row number)."""
    held: list[np.ndarray] = []
    numbers: list[int] = []
    size = 0
    for doc, row, words in _segments(parts, overlap):
        if ids is not None and row == len(ids):
            ids.append(doc)
        if not len(words):
            continue
        held.append(words)
        numbers.append(row)
        size += len(words)
        if size >= _SEGMENT:
            yield _side_by_side(held, numbers)
            held, numbers, size = [], [], 0
    if held:
        yield _side_by_side(held, numbers)


def _side_by_side(held: list[np.ndarray], numbers: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(w) for w in held])
    return np.concatenate(held), np.cumsum(sizes) - sizes, np.array(numbers)


def _pieces(total: int, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every piece of ``size`` words, no piece crossing a document, and the document it is of."""
    sizes = np.diff(np.append(firsts, total))
    counts = -(-sizes // size)
    of = np.repeat(np.arange(len(firsts)), counts)
    number = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    return firsts[of] + number * size, of


def _passages(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(word, piece it is in) of every vocabulary word, and the number of pieces."""
    starts, _ = _pieces(len(words), firsts, size)
    at = np.flatnonzero(words)
    return words[at].astype(np.int64), np.searchsorted(starts, at, "right") - 1, len(starts)


def _frequencies(parts: Iterator[pa.RecordBatch], size: int, settings: Settings) -> Iterator[pa.RecordBatch]:
    """In how many passages each word occurs; the first number is the number of passages."""
    counts = np.zeros(size, np.int64)
    for words, firsts, _ in _stretches(parts, 0):
        own, passage, n = _passages(words, firsts, settings.window)
        counts += np.bincount(np.unique(passage * size + own) % size, minlength=size)
        counts[0] += n
    yield pa.record_batch([pa.array([0], pa.int32()), pa.array([counts.tobytes()], pa.binary())], schema=_SUMS)


def _gram(parts: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    """This task's part of ``A' (A R)``, in bands of terms."""
    weight, sketch, settings = model.value
    terms = len(sketch)
    total = np.zeros(sketch.shape, np.float32)
    for words, firsts, _ in _stretches(parts, 0):
        own, passage, _ = _passages(words, firsts, settings.window)
        used = weight[own] > 0
        own, passage = own[used], passage[used]
        if not len(own):
            continue
        fresh = np.r_[True, passage[1:] != passage[:-1]]
        own_rows = sketch[own % terms]
        own_rows *= weight[own][:, None]
        seen = np.add.reduceat(own_rows, np.flatnonzero(fresh), axis=0)
        order = np.argsort((own % terms).astype(np.uint16), kind="stable")
        share = seen[(np.cumsum(fresh) - 1)[order]]
        share *= weight[own[order]][:, None]
        term = (own % terms)[order]
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        total[term[first]] += np.add.reduceat(share, first, axis=0)
    bands = [(i // _BAND, total[i : i + _BAND].tobytes()) for i in range(0, len(total), _BAND)]
    yield from batches(iter(bands), _SUMS)
    give_back()


def _added(parts: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by band: sums of equal bands."""

    def rows() -> Iterator[tuple]:
        held, total = None, np.zeros(0)
        for part in parts:
            for band, data in zip(*(c.to_pylist() for c in part.columns), strict=True):
                values = np.frombuffer(data, kind)
                if band != held:
                    if held is not None:
                        yield held, total.tobytes()
                    held, total = band, values.astype(values.dtype.str.replace("f4", "f8"))
                else:
                    total = total + values
        if held is not None:
            yield held, total.tobytes()

    yield from batches(rows(), _SUMS)


def _sum_of(frame: DataFrame, kind: str) -> np.ndarray:
    """The sum over all tasks; its size is that of one task's part.  A task's sum per band is made twice, first over
    few of the tasks and then over those, so no task reads the parts of all."""
    spark = frame.sparkSession
    spread = frame.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(_SPREAD)))
    near = spread.repartition(partitions(spark), "band", "part").sortWithinPartitions("part", "band").select("band", "data")
    near = near.mapInArrow(partial(_added, kind=kind), "band int, data binary")
    kind = kind.replace("f4", "f8")
    far = near.repartition(partitions(spark), "band").sortWithinPartitions("band").mapInArrow(partial(_added, kind=kind), "band int, data binary")
    parts = sorted((r["band"], np.frombuffer(r["data"], kind)) for r in far.collect())
    return np.concatenate([data for _, data in parts]) if parts else np.zeros(0)


def weights(counts: np.ndarray, passages: list[_Passage], settings: Settings) -> np.ndarray:
    """Inverse document frequencies by vocabulary number; common words weigh nothing where that leaves enough."""
    idf = np.log((counts[0] + 1) / (counts + 1.0)) + 0.01
    idf[0] = 0
    rare = np.where(counts > settings.common * counts[0], 0, idf)
    for passage in passages:
        if np.count_nonzero(rare[passage.words]) < settings.least_weighted:
            rare[passage.words] = idf[passage.words]
    # rare words have little part in the leading singular vectors, so frequent ones are held down
    return (rare / np.maximum(counts, 1) ** settings.balance).astype(np.float32)


def frequencies(words: DataFrame, size: int, settings: Settings) -> np.ndarray:
    """In how many passages of all documents each word occurs; the first number is the number of passages."""
    counts = _sum_of(words.mapInArrow(partial(_frequencies, size=size, settings=settings), "band int, data binary"), "<i8")
    return counts if len(counts) else np.zeros(size, np.int64)


def latent_space(words: DataFrame, passages: list[_Passage], counts: np.ndarray, settings: Settings) -> np.ndarray:
    """(vocabulary x rank): each word's share of its passage's place in the latent space."""
    spark = words.sparkSession
    size = len(counts)
    terms = min(size, settings.terms)
    if not counts[0]:
        return np.zeros((size, settings.rank), np.float32)
    weight = weights(counts, passages, settings)
    rank = min(settings.rank, terms)
    sketch = np.linalg.qr(np.random.default_rng(7).standard_normal((terms, rank)))[0].astype(np.float32)
    model = spark.sparkContext.broadcast((weight, sketch, settings))
    product = _sum_of(words.mapInArrow(partial(_gram, model=model), "band int, data binary"), "<f4").reshape(terms, rank)
    # Nystroem: A'A is close to P (R'P)^-1 P' for P = A'A R; its eigenvectors are A's right singular vectors
    core = sketch.astype(float).T @ product
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    floor = max(float(values.max()), 1e-9) * 1e-9
    root = vectors @ np.diag(np.where(values > floor, 1 / np.sqrt(np.maximum(values, floor)), 0)) @ vectors.T
    right, _, _ = np.linalg.svd(product @ root, full_matrices=False)
    return (weight[:, None] * right[np.arange(size) % terms]).astype(np.float32)


@dataclass
class _Passage:
    """At most ``item_words`` words of a benchmark item, as vocabulary numbers."""

    item: int
    total: int  # words of the whole item
    words: np.ndarray
    answer: int  # bits of the words that belong to the answer
    at: int  # words of the item before the passage


@dataclass
class _Rare:
    """The rarest words of some passages: for each local number the passages that look for it."""

    first: np.ndarray  # local number to its first place in passage; one more at the end
    passage: np.ndarray
    least: np.ndarray  # how many of its rare words make a passage a candidate
    reach: np.ndarray  # within how many words of a text


def rarest(passages: list[_Passage], counts: np.ndarray, local: np.ndarray, settings: Settings) -> _Rare:
    words, of, least, reach = [], [], [], []
    for n, p in enumerate(passages):
        size = len(p.words)
        short = size < settings.short
        needed = int(np.ceil((settings.copied if short else settings.reworded) * size - 1e-9))
        enough = min(settings.shared, needed)
        own = np.unique(p.words[np.lexsort((p.words, counts[p.words]))[: size - needed + enough]])
        words.append(local[own])
        of.append(np.full(len(own), n))
        least.append(enough)
        reach.append(5 * size // 2 if short else settings.window + 2 * settings.chunk)
    word, passage = np.concatenate(words), np.concatenate(of)
    order = np.argsort(word, kind="stable")
    first = np.searchsorted(word[order], np.arange(int(local.max()) + 2))
    return _Rare(first, passage[order], np.array(least), np.array(reach))


@dataclass
class _Items:
    """Some benchmark passages, made ready for comparing."""

    item: np.ndarray
    total: np.ndarray
    size: np.ndarray
    answer: np.ndarray
    at: np.ndarray  # words of the item before the passage
    local: np.ndarray  # vocabulary number to the number among these passages' words; 0: in none
    masks: np.ndarray  # (passages x local numbers): bits of the positions that hold a word
    places: np.ndarray  # (rank x passages): unit vectors in the latent space
    rare: _Rare


def item_passages(rows: list[tuple[int, str]], settings: Settings) -> tuple[list[_Passage], dict[bytes, int]]:
    """The passages of all items with words, and the vocabulary: numbers from 1."""
    out, vocabulary = [], {}
    for item, text in rows:
        sentences = [w for w in map(words_of, _SENTENCE.split(text)) if w]
        words = [vocabulary.setdefault(w, len(vocabulary) + 1) for s in sentences for w in s]
        if not words:
            continue
        tail = 0
        for sentence in reversed(sentences):  # the last sentence, or as many as make four words
            tail += len(sentence)
            if tail >= 4:
                break
        for own in np.array_split(np.arange(len(words)), -(-len(words) // settings.item_words)):
            answer = sum(1 << i for i, at in enumerate(own.tolist()) if at >= len(words) - tail)
            out.append(_Passage(item, len(words), np.array(words)[own], answer, int(own[0])))
    return out, vocabulary


def _ready(passages: list[_Passage], space: np.ndarray, counts: np.ndarray, settings: Settings) -> _Items:
    own = np.unique(np.concatenate([p.words for p in passages]))
    local = np.zeros(len(space), np.int32)
    local[own] = np.arange(1, len(own) + 1)
    masks = np.zeros((len(passages), len(own) + 1), np.uint32)
    places = np.zeros((space.shape[1], len(passages)), np.float32)
    for n, p in enumerate(passages):
        np.bitwise_or.at(masks[n], local[p.words], np.uint32(1) << np.arange(len(p.words), dtype=np.uint32))
        place = space[p.words].sum(axis=0)
        places[:, n] = place / max(float(np.linalg.norm(place)), 1e-12)
    columns = [np.array(c) for c in zip(*((p.item, p.total, len(p.words), p.answer, p.at) for p in passages), strict=True)]
    rare = rarest(passages, counts, local, settings)
    return _Items(columns[0], columns[1], columns[2], columns[3].astype(np.uint32), columns[4], local, masks, places, rare)


def _sharing(number: np.ndarray, starts: np.ndarray, of: np.ndarray, rare: _Rare, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(piece, passage number): the pieces around which enough of a passage's rare words stand."""
    many = rare.first[number + 1] - rare.first[number]
    at = np.flatnonzero(many)
    many = many[at]
    inner = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    passage = rare.passage[np.repeat(rare.first[number[at]], many) + inner]
    met = np.sort(passage * len(number) + np.repeat(at, many))
    passage, at = met // len(number), met % len(number)
    last = np.arange(len(met)) + rare.least[passage] - 1
    begin = np.flatnonzero(last < len(met))
    last = last[begin]
    near = (passage[last] == passage[begin]) & (at[last] - at[begin] < rare.reach[passage[begin]])
    begin, last = begin[near], last[near]
    low, high = (np.searchsorted(starts, at[x], "right") - 1 for x in (begin, last))
    # the stretch aligned with a piece begins one piece before it and ends ``chunks`` pieces behind it
    pieces = high[:, None] + np.arange(-settings.chunks, 2)
    fits = (of[low] == of[high])[:, None] & (pieces >= 0) & (pieces <= low[:, None] + 1) & (pieces < len(starts))
    fits &= of[np.clip(pieces, 0, len(of) - 1)] == of[low][:, None]
    found = np.unique((passage[begin][:, None] * len(starts) + pieces)[fits])
    return found % len(starts), found // len(starts)


def _together(passages: list[_Passage], most: int = 256) -> Iterator[list[_Passage]]:
    """Some passages at a time, all of an item together."""
    held: list[_Passage] = []
    for passage in passages:
        if len(held) >= most and held[-1].item != passage.item:
            yield held
            held = []
        held.append(passage)
    if held:
        yield held


def _common(masks: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence, bit-parallel: ``masks`` has a row of position bits for each word of
    the text, a column for each candidate."""
    full = (np.uint64(1) << size.astype(np.uint64)) - np.uint64(1)
    state = full.copy()
    for row in masks.astype(np.uint64):
        met = state & row
        state = ((state + met) | (state - met)) & full
    return size - np.bitwise_count(state).astype(np.int64)


def _searched(parts: Iterator[pa.RecordBatch], model: Broadcast, settings: Settings) -> Iterator[pa.RecordBatch]:
    space, blocks = model.value
    weighted = space.any(axis=1)
    for part in parts:
        ids: list[int | None] = []
        found: list[tuple[np.ndarray, ...]] = []
        for words, firsts, rows in _stretches(iter([part]), 2 * settings.window, ids):
            starts, of = _pieces(len(words), firsts, settings.chunk)
            own, piece, n = _passages(words, firsts, settings.chunk)
            own, piece = own[weighted[own]], piece[weighted[own]]
            place = np.zeros((n, space.shape[1]), np.float32)
            if len(own):
                first = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
                place[piece[first]] = np.add.reduceat(space[own], first, axis=0)
            single = place.copy()
            for step in range(1, settings.chunks):
                place[:-step] += np.where((of[:-step] == of[step:])[:, None], single[step:], 0)
            length = np.linalg.norm(place, axis=1)
            place /= np.maximum(length, 1e-12)[:, None]
            windows = np.flatnonzero(length > 1e-12)
            lows, highs = firsts[of], np.append(firsts, len(words))[of + 1]
            for items in blocks:
                number = items.local[words]
                sharing = _sharing(number, starts, of, items.rare, settings)
                compared = _compared(place, windows, sharing, starts, lows, highs, number, items, settings)
                found += [(rows[of[w]], items.item[p], items.total[p], p, *rest) for w, p, *rest in compared]
        yield from _decided(ids, found, settings)
    give_back()


def _compared(place, windows, sharing, starts, lows, highs, number, items: _Items, settings: Settings) -> Iterator[tuple[np.ndarray, ...]]:
    """(piece, passage, cosine, common words, answer words, answer words there) of the candidates of both sources."""
    for lo in range(0, len(windows), 4096):
        some = windows[lo : lo + 4096]
        cosines = place[some] @ items.places
        w, p = np.nonzero(cosines >= settings.cosine)
        yield from _confirmed(some[w], p, cosines[w, p], starts, lows, highs, number, items, settings)
    for lo in range(0, len(sharing[0]), 1 << 14):
        w, p = (x[lo : lo + (1 << 14)] for x in sharing)
        cosine = np.einsum("ij,ji->i", place[w], items.places[:, p])
        rest = cosine < settings.cosine  # the others are candidates already
        yield from _confirmed(w[rest], p[rest], cosine[rest], starts, lows, highs, number, items, settings)


def _confirmed(windows, passages, cosines, starts, lows, highs, number, items: _Items, settings: Settings) -> Iterator[tuple[np.ndarray, ...]]:
    """What of these candidates can be aligned.

    A candidate is one passage of an item; the item's other passages are then aligned where they should stand.
    """
    most = int(items.size.max(initial=0))
    for at in range(0, len(windows), 1 << 14):
        w, p = windows[at : at + (1 << 14)], passages[at : at + (1 << 14)]
        cosine = cosines[at : at + (1 << 14)].astype(float)
        good, *aligned = _aligned(starts[w], lows[w], highs[w], p, number, items, settings)
        w, p, cosine = w[good], p[good], cosine[good]
        if not len(w):
            continue
        yield w, p, cosine, *aligned
        for step in [s for n in range(1, -(-int(items.total[p].max()) // max(1, most)) + 2) for s in (n, -n)]:
            q = p + step
            there = (q >= 0) & (q < len(items.item))
            there &= items.item[np.clip(q, 0, len(items.item) - 1)] == items.item[p]
            v, q, base = w[there], q[there], p[there]
            if len(v):
                shift = starts[v] + items.at[q] - items.at[base]
                good, *aligned = _aligned(shift, lows[v], highs[v], q, number, items, settings)
                v, q = v[good], q[good]
                yield v, q, cosine[there][good], *aligned


def _aligned(starts, lows, highs, p, number, items: _Items, settings: Settings) -> tuple[np.ndarray, ...]:
    """Which candidates share enough words with their passages, and for these: common words, answer words, those there."""
    spots = starts[:, None] + np.arange(-settings.chunk, settings.window + settings.chunk)
    inside = (spots >= lows[:, None]) & (spots < highs[:, None])
    near = np.where(inside, number[np.clip(spots, 0, len(number) - 1)], 0)
    masks = items.masks[p[:, None], near]
    least = items.size[p] * settings.reworded / 2
    # words of the passage that occur at all, wherever: no subsequence can have more
    there = np.bitwise_count(np.bitwise_or.reduce(masks, axis=1)).astype(np.int64)
    good = np.flatnonzero(there >= least)
    masks, p = masks[good].T, p[good]
    common = _common(masks, items.size[p])
    enough = common >= least[good]
    good, p, masks, common = good[enough], p[enough], masks[:, enough], common[enough]
    answer = items.answer[p]
    asked = np.bitwise_count(answer).astype(np.int64)
    low = np.where(answer > 0, np.bitwise_count((answer & -answer.astype(np.int64)).astype(np.uint64) - np.uint64(1)), 0)
    met = np.where(asked > 0, _common((masks & answer) >> low.astype(np.uint32), asked), 0)
    return good, common, asked, met


def _decided(ids: list, found: list[tuple[np.ndarray, ...]], settings: Settings) -> Iterator[pa.RecordBatch]:
    """For each document and item: the best alignment of each passage of the item, added up."""
    names = ["id", "item_id", "cosine", "lcs", "answer"]
    best: dict[tuple[int, int], dict[int, list]] = {}
    for row, item, total, passage, cosine, common, asked, met in found:
        for r, i, t, p, c, n, a, m in zip(*(x.tolist() for x in (row, item, total, passage, cosine, common, asked, met)), strict=True):
            own = best.setdefault((r, i), {}).setdefault(p, [t, a, c, n, m])
            own[2:] = [max(own[2], c), max(own[3], n), max(own[4], m)]
    out = []
    for (r, i), passages in best.items():
        total = next(iter(passages.values()))[0]
        lcs = sum(x[3] for x in passages.values()) / total
        asked = sum(x[1] for x in passages.values())
        answer = sum(x[4] for x in passages.values()) / asked if asked else 0.0
        if lcs >= settings.copied or (lcs >= settings.reworded and answer >= settings.answered):
            out.append((ids[r], i, max(x[2] for x in passages.values()), lcs, answer))
    columns = list(zip(*out, strict=True)) if out else [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer): every benchmark item found in a document.

    ``lcs`` is the share of the item's words that stand in a passage of the document in the item's order, ``answer``
    the same for the item's last sentence.  Words are runs of letters, digits, underscores and non-ASCII characters,
    in lower case.

    Null and empty texts and items have no words and never match; rows without an id are left out.
    Repeated rows and items give one row for each pair of ids.  Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_of(docs).alias("text"))
    texts = texts.where("id IS NOT NULL")
    items = benchmark.select(F.col("item_id").cast("long").alias("item"), text_of(benchmark).alias("text")).where("item IS NOT NULL")
    result = None
    for rows in _in_blocks(items.distinct(), settings):
        passages, vocabulary = item_passages(rows, settings)
        if not passages:
            continue
        known = spark.sparkContext.broadcast(vocabulary)
        words = cut(texts.mapInArrow(partial(_numbered, vocabulary=known), "id long, words binary"))
        counts = frequencies(words, len(vocabulary) + 1, settings)
        space = latent_space(words, passages, counts, settings)
        blocks = [_ready(some, space, counts, settings) for some in _together(passages)]
        model = spark.sparkContext.broadcast((space, blocks))
        hits = words.mapInArrow(partial(_searched, model=model, settings=settings), _HITS_SQL)
        result = hits if result is None else result.unionByName(hits)
    if result is None:
        result = spark.createDataFrame([], _HITS_SQL)
    best = result.groupBy("id", "item_id").agg(*[F.max(c).alias(c) for c in ("cosine", "lcs", "answer")])
    return best.withColumnRenamed("id", "doc_id")


def _in_blocks(items: DataFrame, settings: Settings) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of a bounded number of words, by item id: each is small enough to broadcast."""
    most = settings.passages_at_once * settings.item_words
    size = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    blocks = int(size // most) + 1
    place: Column = F.pmod(F.xxhash64("item"), F.lit(blocks))
    for n in range(blocks):
        yield sorted((r["item"], r["text"]) for r in items.where(place == n).collect())


def without_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents in which no benchmark item was found; rows without an id stay."""
    found = leaks(docs, benchmark, settings).select(F.col("doc_id").alias("id")).distinct()
    rows = packed(docs, key=F.col("doc_id").cast("long"))
    return unpacked(rows.join(found, F.col("key") == F.col("id"), "left_anti"), docs.columns)
