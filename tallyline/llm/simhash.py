"""SimHash near-duplicates: a binary trie over fingerprints, joined with itself.

The sorted distinct fingerprints are a binary trie: a node is a range of equal leading bits.  The join starts at the
pair (root, root) and goes down both sides together.  A pair of nodes carries the number of bits in which its two
paths differ; a pair above the error budget is dropped with everything below it.

One trie of a large table would send each subtree to every subtree whose path is within the budget, ever more of them
as paths grow longer.  So the bits are read in several orders: with a budget of b the 64 bits are b + 1 chunks, of which
two linked fingerprints have at least one in common.  Trie r reads chunk r first, with a budget of zero there, then the
chunks before r, each of which has to differ (else an earlier trie has found the pair), then the others.  A subtree so
meets itself and, only below its first chunk, others.

Each trie is cut into blocks, subtrees of bounded size with their paths.  A block is walked against itself where it
lies; only blocks that meet others travel.  A walk returns a spanning forest of the links it found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import batches, cut, give_back, packed, partitions, small_batches, text_of, unpacked
from tallyline.llm.components import components

BITS = 64
BLANKS = b" \t\n\x0b\x0c\r"
_AT_ONCE = 1 << 16
#: Node pairs that are expanded at once; a walk holds a few such stretches for each level of the trie.
_FRONTIER = 1 << 16
_BLOCKS = pa.schema([("turn", pa.int32()), ("path", pa.int64()), ("depth", pa.int32()), ("members", pa.binary())])
_BLOCKS_SQL = "turn int, path long, depth int, members binary"
_MEETINGS = pa.schema(
    [
        ("left", pa.int64()), ("right", pa.int64()), ("side", pa.int32()), ("turn", pa.int32()), ("common", pa.int32()),
        ("members", pa.binary()),
    ]
)
_MEETINGS_SQL = "left long, right long, side int, turn int, common int, members binary"
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


@dataclass(frozen=True)
class Turn:
    """An order of the bits: chunks (first bit, width), the first ``lead`` bits without errors, and after that
    ``earlier`` chunks with at least one error each."""

    chunks: tuple[tuple[int, int], ...] = ((0, BITS),)
    lead: int = 0
    earlier: int = 0

    def read(self, values: np.ndarray) -> np.ndarray:
        """Values with their bits in this order."""
        return self._moved(values, back=False)

    def back(self, values: np.ndarray) -> np.ndarray:
        return self._moved(values, back=True)

    def _moved(self, values: np.ndarray, back: bool) -> np.ndarray:
        out, at = np.zeros(len(values), np.uint64), 0
        for start, width in self.chunks:
            old, new = (at, start) if back else (start, at)
            piece = (values >> np.uint64(BITS - old - width)) & np.uint64((1 << width) - 1)
            out |= piece << np.uint64(BITS - new - width)
            at += width
        return out

    def bounds(self, budget: int) -> tuple[np.ndarray, np.ndarray]:
        """The least and most errors that the first d bits may hold, for d from 0 to 64."""
        depths = np.arange(BITS + 1)
        ends = np.cumsum([width for _, width in self.chunks])[1 : self.earlier + 1]
        return (depths[:, None] >= ends[None, :]).sum(axis=1), np.where(depths <= self.lead, 0, budget)


def turns(budget: int) -> list[Turn]:
    """One order for each of ``budget + 1`` chunks of the bits."""
    if budget + 1 > BITS // 4:  # chunks of a few bits tell nothing apart
        return [Turn()]
    edges = [i * BITS // (budget + 1) for i in range(budget + 2)]
    chunks = [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [Turn((chunks[r], *chunks[:r], *chunks[r + 1 :]), chunks[r][1], r) for r in range(len(chunks))]


def shingle_hashes(text: str, size: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of every shingle, in arrays of bounded length.  Words are split at ASCII blanks only."""
    words = text.encode().lower().split()  # bytes: lower and split know ASCII alone
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(words) >= size:
        starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _AT_ONCE):
        cuts = zip(starts[at : at + _AT_ONCE].tolist(), ends[at : at + _AT_ONCE].tolist(), strict=True)
        yield np.array([digest(line[i:j], 42) for i, j in cuts], np.uint64)


def fingerprint(text: str, size: int = 3) -> int:
    """A bit is 1 if it is set in over half of the shingle hashes; no words: zero."""
    total, ones = 0, np.zeros(BITS, np.int64)
    for hashes in shingle_hashes(text, size):
        total += len(hashes)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big") if total else 0


def _fingerprints(parts: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for part in parts:
        found = np.fromiter((fingerprint(x, size) for x in part.column("text").to_pylist()), np.uint64, part.num_rows)
        yield pa.record_batch([part.column("id"), pa.array(found.view(np.int64))], names=["id", "fp"])
    give_back()


def _subtrees(values: np.ndarray, most: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(path, depth, members) of trie nodes with at most so many members, over sorted distinct values.

    A path goes down to where members part: what a task's edge leaves of a wide node has the path of what is left.
    """
    stack = [(0, len(values), 0)]
    while stack:
        lo, hi, depth = stack.pop()
        if hi - lo <= most or depth == BITS:
            if hi > lo:
                shared = BITS - (int(values[lo]) ^ int(values[hi - 1])).bit_length()
                yield int(values[lo]) >> (BITS - shared), shared, values[lo:hi]
            continue
        middle = lo + _half(values[lo:hi], depth)
        stack += [(middle, hi, depth + 1), (lo, middle, depth + 1)]


def _half(values: np.ndarray, depth: int) -> int:
    """Where the bit at this depth turns to 1 in a node's sorted members."""
    top = values[0] >> np.uint64(BITS - depth) if depth else np.uint64(0)
    edge = ((int(top) << 1) | 1) << (BITS - depth - 1)
    return int(np.searchsorted(values, np.uint64(edge)))


def _turned(parts: Iterator[pa.RecordBatch], ways: list[Turn]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        values = part.column("fp").to_numpy().view(np.uint64)
        for turn, way in enumerate(ways):
            yield pa.record_batch([np.full(len(values), turn, np.int32), way.read(values).view(np.int64)], names=["turn", "fp"])


def _blocks(parts: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a partition's sorted fingerprints, read in stretches of one trie so that memory stays bounded."""

    def rows() -> Iterator[tuple]:
        held: list[np.ndarray] = []
        size, turn = 0, -1
        for part in parts:
            of = part.column("turn").to_numpy()
            values = part.column("fp").to_numpy().view(np.uint64)
            edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                if size and (of[lo] != turn or size >= 8 * most):
                    yield from stretch(turn, held)
                    held, size = [], 0
                turn = int(of[lo])
                held.append(values[lo:hi])
                size += hi - lo
        if size:
            yield from stretch(turn, held)

    def stretch(turn: int, held: list[np.ndarray]) -> Iterator[tuple]:
        for path, depth, members in _subtrees(np.sort(np.concatenate(held)), most):
            yield turn, np.uint64(path).astype(np.int64).item(), depth, members.tobytes()

    yield from batches(rows(), _BLOCKS)


def _meetings(parts: Iterator[pa.RecordBatch], known, ways: list[Turn], budget: int) -> Iterator[pa.RecordBatch]:
    """Each block once for every other block of its trie that it can be linked with by their paths."""
    bounds = [way.bounds(budget) for way in ways]

    def rows() -> Iterator[tuple]:
        for part in parts:
            for me, turn, path, depth, members in zip(*(c.to_pylist() for c in part.columns), strict=True):
                ids, paths, depths = known.value[turn]
                common = np.minimum(depths, depth)
                own, deep = np.full(len(paths), np.uint64(path & (2**BITS - 1))), np.full(len(paths), depth)
                errors = np.bitwise_count(_prefix(paths, depths, common) ^ _prefix(own, deep, common))
                lead = np.minimum(common, ways[turn].lead)
                same = _prefix(paths, depths, lead) == _prefix(own, deep, lead)
                least, most = bounds[turn]
                for i in np.flatnonzero(same & (errors >= least[common]) & (errors <= most[common]) & (ids != me)):
                    other = int(ids[i])
                    yield min(me, other), max(me, other), int(me > other), turn, int(common[i]), members

    yield from batches(rows(), _MEETINGS)


def _prefix(paths: np.ndarray, depths: np.ndarray, length: np.ndarray) -> np.ndarray:
    return paths >> (depths - length).astype(np.uint64)


def _own_walks(parts: Iterator[pa.RecordBatch], ways: list[Turn], budget: int) -> Iterator[pa.RecordBatch]:
    """Each block against itself."""

    def rows() -> Iterator[tuple]:
        for part in parts:
            for turn, depth, members in zip(*(part.column(c).to_pylist() for c in ("turn", "depth", "members")), strict=True):
                values = np.frombuffer(members, np.uint64)
                yield from _forest(values, values, depth, ways[turn], budget, same=True)

    yield from batches(rows(), _EDGES)
    give_back()


def _walks(parts: Iterator[pa.RecordBatch], ways: list[Turn], budget: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block pair: walk each pair of subtrees when both sides are there."""

    def rows() -> Iterator[tuple]:
        held = None
        for part in parts:
            for left, right, side, turn, common, members in zip(*(c.to_pylist() for c in part.columns), strict=True):
                values = np.frombuffer(members, np.uint64)
                if side == 0:
                    held = left, right, values
                else:
                    assert held is not None and held[:2] == (left, right)
                    yield from _forest(held[2], values, common, ways[turn], budget, same=False)

    yield from batches(rows(), _EDGES)
    give_back()


def _forest(left: np.ndarray, right: np.ndarray, depth: int, way: Turn, budget: int, same: bool) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between two sorted blocks."""
    shift = 0 if same else len(left)
    everything = left if same else np.concatenate([left, right])
    roots = np.arange(len(everything))
    for a, b in _links(left, right, depth, way, budget, same):
        roots = _joined(roots, a, b + shift)
    members = np.flatnonzero(roots != np.arange(len(roots)))
    signed = way.back(everything).view(np.int64)
    yield from zip(signed[roots[members]].tolist(), signed[members].tolist(), strict=True)


def _joined(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest members after some more links: hook roots to smaller roots, then shorten all paths."""
    while True:
        ra, rb = roots[a], roots[b]
        apart = ra != rb
        if not apart.any():
            return roots
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(roots, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            shorter = roots[roots]
            if (shorter == roots).all():
                break
            roots = shorter


def _links(
    left: np.ndarray, right: np.ndarray, depth: int, way: Turn, budget: int, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within the budget: breadth first over node pairs, in stretches taken from a stack.

    ``depth`` is the number of leading bits the members of each side share with one another.  Pairs that another trie
    has to find are left to it, or found here too where few members are compared at once.
    """
    least, most = way.bounds(budget)
    start = np.array([[0], [len(left)], [0], [len(right)]], np.int64)
    differ = 0 if same else int(_lead(left[0], depth) ^ _lead(right[0], depth)).bit_count()
    stack = [(depth, start, np.array([differ], np.int8))] if least[depth] <= differ <= most[depth] else []
    while stack:
        depth, nodes, errors = stack.pop()
        if nodes.shape[1] > _FRONTIER:
            half = nodes.shape[1] // 2
            stack += [(depth, nodes[:, half:], errors[half:]), (depth, nodes[:, :half], errors[:half])]
            continue
        alo, ahi, blo, bhi = nodes
        small = ((ahi - alo) * (bhi - blo) <= 16) | (depth == BITS)
        if small.any():
            yield from _close(left, right, nodes[:, small], budget, same)
            nodes, errors = nodes[:, ~small], errors[~small]
            alo, ahi, blo, bhi = nodes
        if not nodes.shape[1]:
            continue
        amid, bmid = _middles(left, alo, ahi, depth), _middles(right, blo, bhi, depth)
        twin = (alo == blo) & (ahi == bhi) if same else np.zeros(len(alo), bool)
        below = [
            (np.stack([alo, amid, blo, bmid]), errors, None),
            (np.stack([amid, ahi, bmid, bhi]), errors, None),
            (np.stack([alo, amid, bmid, bhi]), errors + 1, None),
            (np.stack([amid, ahi, blo, bmid]), errors + 1, ~twin),
        ]
        kept, wrong = [], []
        for child, error, allowed in below:
            alive = (child[0] < child[1]) & (child[2] < child[3]) & (error >= least[depth + 1]) & (error <= most[depth + 1])
            if allowed is not None:
                alive &= allowed
            kept.append(child[:, alive])
            wrong.append(error[alive])
        nodes, errors = np.concatenate(kept, axis=1), np.concatenate(wrong)
        if nodes.shape[1]:
            stack.append((depth + 1, nodes, errors))


def _lead(value: np.uint64, depth: int) -> int:
    return int(value) >> (BITS - depth) if depth else 0


def _middles(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """First member with a 1 at this depth, for many nodes at once: a binary search in step."""
    bit = np.uint64(1 << (BITS - 1 - depth))
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        middle = (lo + hi) >> 1
        one = (values[np.minimum(middle, len(values) - 1)] & bit) != 0
        hi = np.where(open_ & one, middle, hi)
        lo = np.where(open_ & ~one, middle + 1, lo)


def _close(left: np.ndarray, right: np.ndarray, nodes: np.ndarray, budget: int, same: bool) -> Iterator[tuple]:
    """Node pairs with a few members on each side: compare the members."""
    alo, ahi, blo, bhi = nodes
    width, counts = bhi - blo, (ahi - alo) * (bhi - blo)
    for lo in range(0, len(counts), _FRONTIER // 4):
        here = slice(lo, lo + _FRONTIER // 4)
        n = counts[here]
        which = np.repeat(np.arange(len(n)), n)
        rank = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        a = alo[here][which] + rank // width[here][which]
        b = blo[here][which] + rank % width[here][which]
        near = np.bitwise_count(left[a] ^ right[b]) <= budget
        if same:
            near &= a != b
        if near.any():
            yield a[near], b[near]


def trie_blocks(prints: DataFrame, ways: list[Turn], n: int, least_block: int, most_blocks: int) -> DataFrame:
    """(block, turn, path, depth, members): the blocks of one trie for each order of the bits, cut."""
    most = max(least_block, -(-n * len(ways) // most_blocks))
    tasks = max(1, -(-n * len(ways) // (4 * most)))
    turned = prints.mapInArrow(partial(_turned, ways=ways), "turn int, fp long")
    ordered = turned.repartitionByRange(tasks, "turn", "fp").sortWithinPartitions("turn", "fp")
    cut_up = ordered.mapInArrow(partial(_blocks, most=most), _BLOCKS_SQL)
    return cut(cut_up.select(F.monotonically_increasing_id().alias("block"), "turn", "path", "depth", "members"))


def block_meetings(blocks: DataFrame, ways: list[Turn], budget: int) -> DataFrame:
    """(left, right, side, turn, common, members): both sides of each pair of blocks to be walked."""
    paths = blocks.select("block", "turn", "path", "depth").toPandas()
    known = []
    for turn in range(len(ways)):
        mine = paths[paths["turn"] == turn]
        known.append((mine["block"].to_numpy(np.int64), mine["path"].to_numpy(np.int64).view(np.uint64), mine["depth"].to_numpy(np.int64)))
    sent = blocks.sparkSession.sparkContext.broadcast(known)
    return blocks.mapInArrow(partial(_meetings, known=sent, ways=ways, budget=budget), _MEETINGS_SQL)


def linked(prints: DataFrame, budget: int = 3, least_block: int = 1 << 14, most_blocks: int = 1 << 15) -> DataFrame:
    """(node, root) of every fingerprint (column ``fp``, distinct) that is within ``budget`` bits of another.

    Blocks hold ``least_block`` fingerprints, more only where the table is so large that its tries would have over
    ``most_blocks`` of them: what is broadcast is the path of each block and has that bound.  A table of one block is
    one trie.
    """
    spark = prints.sparkSession
    n = prints.count()
    ways = turns(budget) if n > least_block else [Turn()]
    blocks = trie_blocks(prints, ways, n, least_block, most_blocks)
    meetings = block_meetings(blocks, ways, budget)
    pairs = meetings.repartition(max(partitions(spark), blocks.rdd.getNumPartitions()), "left", "right")
    walks = pairs.sortWithinPartitions("left", "right", "side").mapInArrow(
        partial(_walks, ways=ways, budget=budget), "a long, b long"
    )
    own = blocks.mapInArrow(partial(_own_walks, ways=ways, budget=budget), "a long, b long")
    return components(own.unionByName(walks))


def simhash_groups(docs: DataFrame, size: int = 3, budget: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row: near-duplicate groups by 64-bit SimHash.

    Text is lower-cased in A-Z and split at ASCII blanks; shingles are ``size`` words joined by a space, repeats
    included (fewer words: all of them; none: fingerprint zero, linked like any other).  ``fp`` is the fingerprint as
    a signed long.  Fingerprints link at ``budget`` or fewer differing bits; ``component_id`` is the smallest document
    id reachable, the row's own included.  Null texts are empty.  Rows with a null id keep it and take part in links;
    their component is null if no document in it has an id.  Repeated rows give repeated rows.
    """
    small_batches(docs.sparkSession)
    ids = F.col(doc_id).cast("long")
    prints = cut(
        docs.select(ids.alias("id"), text_of(docs, text).alias("text")).mapInArrow(
            partial(_fingerprints, size=size), "id long, fp long"
        )
    )
    firsts = cut(prints.groupBy("fp").agg(F.min("id").alias("first")))
    roots = linked(firsts.select("fp"), budget)
    rooted = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    groups = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root")
    return prints.join(groups.select("fp", "component_id"), "fp").select(F.col("id").alias(doc_id), "fp", "component_id")


def one_per_group(docs: DataFrame, size: int = 3, budget: int = 3) -> DataFrame:
    """The documents whose id is their group's smallest, with all their columns.

    Null and empty texts are one group like any other.  Rows without an id have no group to lose to and stay; repeated
    rows of a kept id all stay.
    """
    groups = simhash_groups(docs, size, budget)
    losers = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("id")).distinct()
    rows = packed(docs, key=F.col("doc_id").cast("long"))
    return unpacked(rows.join(losers, F.col("key") == F.col("id"), "left_anti"), docs.columns)
