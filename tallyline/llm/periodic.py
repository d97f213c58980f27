"""Periodic runs of words: stretches that repeat with a small period, found exactly.

A run is a stretch of consecutive words with smallest period q and at least ``max(least, 2 * q)`` words that no
neighbouring word extends.

1. Splitting.  Every word of a run stands in it twice at least, so a word that stands once in a segment is in no run
   of that segment and splits it.  The parts are split again by their own counts until nothing changes.  The places
   of a word's neighbours (its equal words before and after) tell a single word without counting again: rounds over
   all segments of a batch come first, and what is not settled by then is searched from both ends at once, which
   costs the shorter part of each split.
2. Lag scan.  What survives is compared with itself at each lag.  The matches of a run at its period q are a stretch
   of at least ``max(least - q, q)`` places, so it is enough to look at every so many places (anchors) and to extend
   those that match.  Lags go in bands of doubling width, so a band costs about one comparison for each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tallyline.llm.common import give_back, packed, small_batches, text_of, unpacked
from tallyline.llm.words import joined, split_words

#: Rounds over all segments at once before the rest is searched one by one.
_ROUNDS = 6
#: Comparisons that are held at once.
_AT_ONCE = 1 << 20
_RUN = StructType().add("start", "long").add("length", "long").add("period", "long")


# ---------------------------------------------------------------- splitting


def _neighbours(codes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the equal word before and after each word, in the same document; far outside where there is none."""
    n = len(codes)
    key = owners * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    before, after = np.full(n, -1), np.full(n, n)
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def surviving(codes: np.ndarray, counts: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Segments (from, to) of at least ``least`` words in which no word stands only once, in order.

    ``codes`` numbers the words of all documents, ``counts`` tells how many each document has.
    """
    owners = np.repeat(np.arange(len(counts)), counts)
    before, after = _neighbours(codes, owners)
    hi = np.cumsum(counts)
    lo = hi - counts
    settled: list[tuple[int, int]] = []
    for _ in range(_ROUNDS):
        long = hi - lo >= least
        lo, hi = lo[long], hi[long]
        if not len(lo):
            break
        sizes = hi - lo
        at = np.repeat(lo - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        left, right = np.repeat(lo, sizes), np.repeat(hi, sizes)
        twice = (before[at] >= left) | (after[at] < right)
        whole = np.logical_and.reduceat(twice, np.cumsum(sizes) - sizes)
        settled += zip(lo[whole].tolist(), hi[whole].tolist(), strict=True)
        rest = twice & ~np.repeat(whole, sizes)
        at, left = at[rest], left[rest]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (left[1:] != left[:-1])
        lo = at[new]
        hi = at[np.r_[new[1:], True]] + 1 if len(at) else lo
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        settled += _settled(before, after, a, b, least)
    return sorted(settled)


def _settled(before: np.ndarray, after: np.ndarray, lo: int, hi: int, least: int) -> Iterator[tuple[int, int]]:
    """The same for one segment: single words are looked for from both ends."""
    base, prior, later = lo, before[lo:hi].tolist(), after[lo:hi].tolist()
    open_ = [(lo, hi)]
    while open_:
        lo, hi = open_.pop()
        if hi - lo < least:
            continue
        for k in range((hi - lo + 1) // 2):
            single = next((p for p in (lo + k, hi - 1 - k) if prior[p - base] < lo and later[p - base] >= hi), None)
            if single is not None:
                open_ += [(lo, single), (single + 1, hi)]
                break
        else:
            yield lo, hi


# ---------------------------------------------------------------- lag scan


def runs_in(codes: np.ndarray, sizes: np.ndarray, least: int) -> dict[tuple[int, int], int]:
    """Period by (from, to) of every run inside consecutive segments of the given sizes.

    A word has one number in a segment and other numbers in other segments.
    """
    found: dict[tuple[int, int], int] = {}
    n, longest = len(codes), int(sizes.max(initial=0))
    size_at = np.repeat(sizes, sizes)
    first = 1
    while max(least, 2 * first) <= longest:
        lags = range(first, 2 * first)
        stride = min(max(least - q, q) for q in lags)
        anchors = np.arange(0, n, stride)
        anchors = anchors[size_at[anchors] >= max(least, 2 * first)]
        places, lag = _matches(codes, anchors, first, stride)
        fresh = ~_inside(found, places, lag, first)
        places, lag = places[fresh], lag[fresh]
        order = np.lexsort((places, lag))
        q = end = -1
        for a, own in zip(places[order].tolist(), lag[order].tolist(), strict=True):
            if own == q and a < end:
                continue
            start, end = _stretch(codes, a, own)
            q = own
            if end - start >= max(least - q, q):
                found.setdefault((start, end + q), q)
        first *= 2
    return found


def _matches(codes: np.ndarray, anchors: np.ndarray, first: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) for lags of one band: anchors that match, with enough matches on one side to be in a stretch of
    ``stride`` matches."""
    n, half = len(codes), max(1, stride // 2)
    padded = np.r_[np.full(half, -1), codes, np.full(2 * first + half, -2)]
    band = np.lib.stride_tricks.sliding_window_view(padded, first)
    some_places, some_lags = [], []
    rows = max(1, _AT_ONCE // first)
    for at in range(0, len(anchors), rows):
        here = anchors[at : at + rows]
        which, lag = np.nonzero(band[here + half + first] == codes[here][:, None])
        place, lag = here[which], lag + first
        near = sorted({min(d, half) for d in (1, 2, half // 2, half) if d})
        ahead, behind = np.ones(len(place), bool), np.ones(len(place), bool)
        for d in near:
            ahead &= padded[place + half + d - 1] == padded[place + half + lag + d - 1]
            behind &= padded[place + half - d] == padded[place + half + lag - d]
        good = (ahead | behind) & (place + lag < n)
        some_places.append(place[good])
        some_lags.append(lag[good])
    if not some_places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(some_places), np.concatenate(some_lags)


def _inside(found: dict[tuple[int, int], int], places: np.ndarray, lags: np.ndarray, first: int) -> np.ndarray:
    """Matches that only show a run known already: they lie in it, at a multiple of its period."""
    known = np.zeros(len(places), bool)
    if not len(places):
        return known
    for (start, end), period in found.items():
        if end - start > first:
            lo, hi = np.searchsorted(places, (start, end))
            if lo < hi:
                known[lo:hi] |= (places[lo:hi] + lags[lo:hi] < end) & (lags[lo:hi] % period == 0)
    return known


def _stretch(codes: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """The matches at this lag around a place, from and to, in steps of doubling length."""
    n = len(codes) - lag
    end, step = place, 16
    while end < n:
        stop = min(n, end + step)
        same = codes[end:stop] == codes[end + lag : stop + lag]
        if not same.all():
            end += int(same.argmin())
            break
        end, step = stop, 2 * step
    start, step = place, 16
    while start > 0:
        begin = max(0, start - step)
        same = codes[begin:start] == codes[begin + lag : start + lag]
        if not same.all():
            start -= int(same[::-1].argmin())
            break
        start, step = begin, 2 * step
    return start, end


def runs_of(codes: np.ndarray, counts: np.ndarray, least: int = 12) -> np.ndarray:
    """(document, from, to, period) of every run, by document, start and period; places count over all documents."""
    segments = surviving(codes, counts, least)
    if not segments:
        return np.zeros((0, 4), np.int64)
    lo, hi = np.array(segments, np.int64).T
    sizes = hi - lo
    begins = np.cumsum(sizes) - sizes
    shift = np.repeat(lo - begins, sizes)
    at = shift + np.arange(len(shift))
    own = np.repeat(np.arange(len(sizes)), sizes) * (int(codes.max()) + 1) + codes[at]
    found = runs_in(own, sizes, least)
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = np.array([(s, e, q) for (s, e), q in found.items()], np.int64)
    move = shift[rows[:, 0]]
    start, end, period = rows[:, 0] + move, rows[:, 1] + move, rows[:, 2]
    owner = np.searchsorted(np.cumsum(counts), start, side="right")
    return np.stack([owner, start, end, period], axis=1)[np.lexsort((period, start, owner))]


# ---------------------------------------------------------------- documents


def _periodic(parts: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for part in parts:
        words, counts = split_words(part.column("text"))
        codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        found = runs_of(codes, counts, least) if len(codes) else np.zeros((0, 4), np.int64)
        owner, start, end, period = found.T
        edges = np.zeros(len(codes) + 1, np.int64)
        np.add.at(edges, start + period, 1)
        np.add.at(edges, end, -1)
        kept = np.cumsum(edges[:-1]) == 0
        firsts = np.r_[0, np.cumsum(counts)]
        left = np.add.reduceat(np.r_[kept, False], firsts[:-1]) * (counts > 0) if len(counts) else counts
        each = pa.StructArray.from_arrays(
            [pa.array(start - firsts[owner]), pa.array(end - start), pa.array(period)], names=["start", "length", "period"]
        )
        offsets = pa.array(np.r_[0, np.cumsum(np.bincount(owner, minlength=len(counts)))], pa.int32())
        yield pa.record_batch(
            [part.column("row"), pa.array(counts), pa.ListArray.from_arrays(offsets, each), joined(words.filter(pa.array(kept)), left)],
            names=["row", "n_words", "runs", "collapsed"],
        )
    give_back()


def periodic_runs(docs: DataFrame, least: int = 12, text: str = "text") -> DataFrame:
    """The columns of ``docs``, then ``n_words``, ``runs`` and ``collapsed``; columns of these names are replaced.

    Words are cut at ASCII blanks.  ``runs`` holds (start, length, period) in words, by start, then period.
    ``collapsed`` is the text's words joined by one space, without the words that some run contains after its first
    period.  Null, empty and blank texts have no words, no runs and an empty collapsed text.  Rows are taken one by
    one: ids may be null or repeated.  A text of any length is one value and is taken whole.
    """
    small_batches(docs.sparkSession)
    rows = packed(docs, text=text_of(docs, text))
    shape = StructType([rows.schema["row"]]).add("n_words", "long").add("runs", ArrayType(_RUN))
    found = rows.mapInArrow(partial(_periodic, least=least), shape.add("collapsed", "string"))
    return unpacked(found, docs.columns, n_words=F.col("n_words"), runs=F.col("runs"), collapsed=F.col("collapsed"))
