"""MinHash near-duplicates with tensored banding.

A document's set is its distinct word shingles.  Two small collections of hash groups (``groups`` each, ``rows``
minhashes a group) give every set the keys A_1.. and B_1..; the table for (i, j) is keyed by the pair A_i, B_j.  So
``groups`` squared tables need only ``2 * groups * rows`` minhashes, and two sets meet in a table exactly if they agree
in some A and in some B.  Two sets with similarity s miss each other with a probability of about
``2 * (1 - s**rows) ** groups``: one in a million for the given numbers at s = 0.8, less above.

Candidates are confirmed on full sets.  No step emits all pairs of a group:

1. Equal sets are one node.
2. Leaders.  Each A table links its members to one leader, the set that meets most others.  These stars, where the B
   keys agree too, are confirmed and joined to components.  A set's family is its leader that meets most.
3. Families and tables (A_i, B_j) may hold more than one component still.  Their members meet in blocks of bounded size,
   those of a family once, those of different families in the first A table they share; a task confirms pairs of
   different components that agree in some A and some B, and returns a spanning forest of the links it found.

Sets are not stored: those of documents that take part are made again from the texts, which a bounded filter of their
ids lets through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.bloom import filter_of, may_hold, mixed
from tallyline.llm.common import batches, cut, give_back, partitions, small_batches, text_of
from tallyline.llm.components import components
from tallyline.llm.words import split_words

#: Shingles that are hashed at once: they and a buffer stay in the processor's cache.
_AT_ONCE = 1 << 15
#: Links that a task takes while components are made.
_EDGES_PER_TASK = 2_000
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one after another, and how many each text has.

    A shingle is ``size`` words; a text with fewer words has one shingle, all of them; no words, no shingle.  Hashes
    have 64 bits, so two shingles of a set are taken for one with probability 2**-64.
    """
    words, counts = split_words(texts, lower=True)
    coded = words.dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    of_word = np.fromiter((digest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    hashes = of_word[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    factors = _odd(size, 1)
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    full = np.flatnonzero(np.arange(len(hashes)) - first[owner] <= counts[owner] - size)
    found = [np.zeros(len(full), np.uint64)]
    owners = [owner[full]]
    for j in range(size):
        found[0] += hashes[np.minimum(full + j, max(0, len(hashes) - 1))] * factors[j]
    for n in range(1, size):
        few = np.flatnonzero(counts == n)
        whole = np.full(len(few), n, np.uint64)  # the number of words sets it apart from longer shingles
        for j in range(n):
            whole += hashes[first[few] + j] * factors[j]
        found.append(whole)
        owners.append(few)
    shingles, owner = mixed(np.concatenate(found)), np.concatenate(owners)
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    fresh = np.ones(len(shingles), bool)
    fresh[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[fresh], np.bincount(owner[fresh], minlength=len(counts))


def set_digests(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """128 bits for each set, as two longs."""
    starts = np.cumsum(counts) - counts
    out = np.zeros((2, len(counts)), np.uint64)
    some = counts > 0
    for k, salt in enumerate(_odd(2, 2)):
        if some.any():
            out[k, some] = np.add.reduceat(mixed(shingles ^ salt), starts[some])
    return out.view(np.int64)


def group_keys(shingles: np.ndarray, counts: np.ndarray, groups: int, rows: int) -> np.ndarray:
    """Keys of the hash groups of each set (all of them nonempty), one row for each set: each is made of ``rows`` minhashes."""
    factors, offsets = _odd(groups * rows, 3), _odd(groups * rows, 4)
    ends = np.cumsum(counts)
    least = np.empty((len(counts), groups * rows), np.uint64)
    lo = 0
    while lo < len(counts):
        begin = ends[lo] - counts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, begin + _AT_ONCE, side="right")))
        part = shingles[begin : ends[hi - 1]]
        starts = ends[lo:hi] - counts[lo:hi] - begin
        buffer = np.empty_like(part)
        for k in range(groups * rows):
            np.multiply(part, factors[k], out=buffer)
            buffer += offsets[k]
            least[lo:hi, k] = np.minimum.reduceat(buffer, starts)
        lo = hi
    keys = np.zeros((len(counts), groups), np.uint64) + np.arange(groups, dtype=np.uint64)
    for r, factor in enumerate(_odd(rows, 5)):
        keys += least[:, r::rows] * factor
    return mixed(keys).view(np.int64)


# ---------------------------------------------------------------- reading documents


def _sketches(parts: Iterator[pa.RecordBatch], size: int, groups: int, rows: int) -> Iterator[pa.RecordBatch]:
    for part in parts:
        shingles, counts = shingle_sets(part.column("text"), size)
        some = counts > 0
        keys = np.zeros((len(counts), 2 * groups), np.int64)
        if some.any():
            keys[some] = group_keys(shingles, counts[some], 2 * groups, rows)
        offsets = pa.array(np.arange(len(counts) + 1) * groups, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(k).ravel())) for k in (keys[:, :groups], keys[:, groups:])]
        d1, d2 = set_digests(shingles, counts)
        yield pa.record_batch([part.column("id"), pa.array(counts), pa.array(d1), pa.array(d2), *lists], names=["id", "n", "d1", "d2", "a", "b"])
    give_back()


def _sets(parts: Iterator[pa.RecordBatch], size: int, wanted) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("members", pa.binary())])

    def rows() -> Iterator[tuple]:
        for part in parts:
            chosen = pa.array(may_hold(wanted.value, part.column("id")))
            shingles, counts = shingle_sets(part.column("text").filter(chosen), size)
            d1, d2 = set_digests(shingles, counts)
            ends = np.cumsum(counts).tolist()
            for one, two, n, end in zip(d1.tolist(), d2.tolist(), counts.tolist(), ends, strict=True):
                if n:
                    yield one, two, shingles[end - n : end].tobytes()

    yield from batches(rows(), schema)
    give_back()


# ---------------------------------------------------------------- confirming


def _similar(both: np.ndarray, one: np.ndarray | int, other: np.ndarray, percent: int) -> np.ndarray:
    return 100 * both >= percent * (one + other - both)


def _confirmed(parts: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets are similar."""

    def rows() -> Iterator[tuple]:
        for part in parts:
            for a, b, left, right in zip(*(c.to_pylist() for c in part.columns), strict=True):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if _similar(both, len(x), np.int64(len(y)), percent):
                    yield a, b

    yield from batches(rows(), _EDGES)
    give_back()


class _Block:
    """Some members of one family or table."""

    def __init__(self, rows: list[tuple]):
        nodes, comps, families, a, b, members = zip(*rows, strict=True)
        self.nodes, self.comps, self.families = np.array(nodes), np.array(comps), np.array(families)
        self.a, self.b = np.array(a), np.array(b)
        self.sets = [np.frombuffer(m, np.uint64) for m in members]
        self.sizes = np.array([len(s) for s in self.sets])


def _forest(table: bool, key: int, left: _Block, right: _Block, percent: int, same: bool) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between two blocks of a family or table, over the components known so far."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    # a table's place is the same for all members, as a key holds its number
    earlier = int((left.a[0] == key).argmax()) if table else left.a.shape[1]
    for i in range(len(left.nodes)):
        size = left.sizes[i]
        able = (right.comps != left.comps[i]) & (100 * np.minimum(right.sizes, size) >= percent * np.maximum(right.sizes, size))
        if same:
            able[: i + 1] = False
        able &= (right.b == left.b[i]).any(axis=1)
        met = (right.a[:, :earlier] == left.a[i, :earlier]).any(axis=1)
        able &= ~met & (right.families != left.families[i]) if table else met
        others = np.flatnonzero(able)
        if len(others):
            own = find(int(left.comps[i]))
            others = np.array([j for j in others.tolist() if find(int(right.comps[j])) != own], np.int64)
        if not len(others):
            continue
        sizes = right.sizes[others]
        joined = np.concatenate([right.sets[j] for j in others.tolist()])
        at = np.minimum(np.searchsorted(left.sets[i], joined), size - 1)
        both = np.add.reduceat((left.sets[i][at] == joined).astype(np.int64), np.cumsum(sizes) - sizes)
        for j in others[_similar(both, size, sizes, percent)].tolist():
            mine, other = find(int(left.comps[i])), find(int(right.comps[j]))
            if mine != other:
                root[max(mine, other)] = min(mine, other)
                yield int(left.nodes[i]), int(right.nodes[j])


def _meetings(parts: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by family or table, block pair and side; the two blocks of one pair are held at a time."""

    def rows() -> Iterator[tuple]:
        held: tuple | None = None
        sides: tuple[list, list] = [], []
        for part in parts:
            columns = (c.to_pylist() for c in part.columns)
            for table, key, left, right, side, *member in zip(*columns, strict=True):
                if (table, key, left, right) != held:
                    yield from met(held, sides)
                    held, sides = (table, key, left, right), ([], [])
                sides[side].append(tuple(member))
        yield from met(held, sides)

    def met(held: tuple | None, sides: tuple[list, list]) -> Iterator[tuple]:
        if held is None or not sides[0]:
            return
        table, key, one, other = held
        first = _Block(sides[0])
        if one == other:
            yield from _forest(table, key, first, first, percent, same=True)
        elif sides[1]:
            yield from _forest(table, key, first, _Block(sides[1]), percent, same=False)

    yield from batches(rows(), _EDGES)
    give_back()


# ---------------------------------------------------------------- the join


class _Join:
    """The steps of the join over one table of documents."""

    def __init__(self, docs: DataFrame, size: int, percent: int, groups: int, rows: int, block_bytes: int):
        self.spark, self.docs = docs.sparkSession, docs
        self.size, self.percent, self.block_bytes = size, percent, block_bytes
        shape = "id long, n long, d1 long, d2 long, a array<long>, b array<long>"
        made = docs.mapInArrow(partial(_sketches, size=size, groups=groups, rows=rows), shape)
        self.sketches = cut(made.withColumn("node", F.monotonically_increasing_id()))
        some = self.sketches.where("n > 0")
        #: One node for each distinct set: its row, and the smallest id that has it.
        self.classes = cut(some.groupBy("d1", "d2").agg(F.min("node").alias("node"), F.min("id").alias("first")))
        self.nodes = cut(some.join(self.classes.select("node"), "node", "left_semi"))

    def roots(self) -> DataFrame:
        """(node, root) of every set that is linked to another."""
        members = self._members()
        pairs, families = self._pairs(members)
        stars = cut(self._stars(pairs))
        roots = cut(components(stars, _EDGES_PER_TASK))
        others = cut(self._left_over(members, families, roots))
        # the later links join components only: each node's root, then its root's root
        known = [roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b")]
        joined = others.join(known[0], "a", "left").join(known[1], "b", "left")
        joined = joined.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
        later = cut(components(joined, _EDGES_PER_TASK)).select(F.col("node").alias("below"), F.col("root").alias("top"))
        first = roots.join(later, F.col("root") == F.col("below"), "left").select("node", F.coalesce("top", "root").alias("root"))
        # sets that only the later links join are in no component of the first
        alone = later.join(roots.select("node"), F.col("below") == F.col("node"), "left_anti")
        return first.unionByName(alone.select(F.col("below").alias("node"), F.col("top").alias("root")))

    def _members(self) -> DataFrame:
        """(key, node, score) of every A table with two members or more; a node's score is the number it meets."""
        tables = self.nodes.select("node", F.explode("a").alias("key"))
        shared = tables.groupBy("key").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
        held = cut(tables.join(shared, "key"))
        scores = held.groupBy("node").agg(F.sum("met").alias("score"))
        return cut(held.select("key", "node").join(scores, "node"))

    def _sets(self, nodes: DataFrame) -> DataFrame:
        """(node, members) for some nodes."""
        wanted = cut(self.nodes.select("node", "id", "d1", "d2").join(nodes, "node", "left_semi"))
        filter_ = self.spark.sparkContext.broadcast(filter_of(wanted.select("id")))
        shape = "d1 long, d2 long, members binary"
        sets = self.docs.mapInArrow(partial(_sets, size=self.size, wanted=filter_), shape).dropDuplicates(["d1", "d2"])
        return cut(sets.join(wanted.select("node", "d1", "d2"), ["d1", "d2"]).select("node", "members"))

    def _pairs(self, members: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(node, leader) that agree in some A and some B and could be similar by their sizes, and each node's family."""
        # the best score and, of those, the smallest node, as one number that a hash aggregation can hold
        place = F.col("score").cast("decimal(38,0)") * F.expr("10000000000000000000BD") - F.col("node")
        leaders = members.groupBy("key").agg(F.max_by("node", place).alias("leader"), F.max(place).alias("place"))
        led = members.join(leaders, "key").groupBy("node", "leader").agg(F.max("place").alias("place"))
        facts = self.nodes.select("node", "n", "b")
        lead = facts.select(F.col("node").alias("leader"), F.col("n").alias("m"), F.col("b").alias("c"))
        near = 100 * F.least("n", "m") >= self.percent * F.greatest("n", "m")
        met = led.join(facts, "node").join(lead, "leader").where(near & F.arrays_overlap("b", "c"))
        met = cut(met.select("node", "leader", "place"))
        families = met.groupBy("node").agg(F.max_by("leader", "place").alias("family"))
        return met.where("node <> leader").select("node", "leader"), cut(families)

    def _stars(self, pairs: DataFrame) -> DataFrame:
        sets = self._sets(pairs.select("node").unionByName(pairs.select(F.col("leader").alias("node"))).distinct())
        both = pairs.join(sets, "node").join(sets.select(F.col("node").alias("leader"), F.col("members").alias("others")), "leader")
        return both.select("node", "leader", "members", "others").mapInArrow(partial(_confirmed, percent=self.percent), "a long, b long")

    def _left_over(self, members: DataFrame, families: DataFrame, roots: DataFrame) -> DataFrame:
        """Links between the components that the stars left."""

        def rooted(rows: DataFrame) -> DataFrame:
            return rows.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")

        several = F.min("comp") < F.max("comp")
        # families that hold several components
        known = cut(rooted(families))
        open_ = known.join(known.groupBy("family").agg(several.alias("mixed")).where("mixed").select("family"), "family")
        of_family = open_.select(F.lit(False).alias("table"), F.col("family").alias("key"), "node", "comp", "family")
        # tables that hold several components of several families
        placed = rooted(members.select("key", "node").join(families, "node", "left"))
        placed = placed.withColumn("family", F.coalesce("family", "node"))
        several = several & (F.min("family") < F.max("family"))
        placed = placed.join(placed.groupBy("key").agg(several.alias("mixed")).where("mixed").select("key"), "key")
        pairs = cut(placed).join(self.nodes.select("node", "b"), "node")
        pairs = pairs.select("key", "node", "comp", "family", F.explode("b").alias("other"))
        meet = pairs.groupBy("key", "other").agg(several.alias("mixed")).where("mixed").select("key", "other")
        of_table = pairs.join(meet, ["key", "other"]).select("key", "node", "comp", "family").distinct()
        alive = cut(of_family.unionByName(of_table.select(F.lit(True).alias("table"), "*")))
        facts = self.nodes.select("node", "n", "a", "b").join(alive.select("node").distinct(), "node", "left_semi")
        whole = facts.join(self._sets(facts.select("node")), "node")
        # they are cut into blocks of bounded size, and every two blocks of one family or table meet
        group = ["table", "key"]
        size = alive.join(facts.select("node", "n"), "node").groupBy(*group).agg(F.sum(F.col("n") * 8 + 400).alias("bytes"))
        blocks = size.select(*group, F.ceil(F.col("bytes") / self.block_bytes).cast("int").alias("blocks"))
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        spread = alive.join(blocks, group).withColumn("own", own)
        spread = spread.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        meeting = spread.select(
            *group,
            F.least("own", "other").alias("left"),
            F.greatest("own", "other").alias("right"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "node",
            "comp",
            "family",
        )
        rows = meeting.join(whole, "node").select(*meeting.columns, "a", "b", "members")
        place = [*group, "left", "right"]
        dealt = rows.repartition(partitions(self.spark), *place).sortWithinPartitions(*place, "side")
        return dealt.mapInArrow(partial(_meetings, percent=self.percent), "a long, b long")


def minhash_groups(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    groups: int = 20,
    rows: int = 3,
    block_bytes: int = 2 << 20,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row: near-duplicate groups by Jaccard similarity.

    A-Z is lower-cased and words are cut at ASCII blanks.  Sets of ``size``-word shingles link if
    ``100 * intersection >= percent * union``.  ``component_id`` is the smallest document id reachable, the row's own
    included, and ``kept`` tells whether the row has that id.  Null, empty and blank texts have no shingles and are
    linked with nothing.  Rows with a null id take part; their component is null, and they are kept, if no document in
    it has an id.  Repeated rows give repeated rows; rows of one id with different texts are different documents.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), text_of(docs, text).alias("text"))
    join = _Join(texts, size, percent, groups, rows, block_bytes)
    rooted = join.classes.join(join.roots(), "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component"))
    of_set = rooted.join(firsts, "root").select("d1", "d2", "component")
    rows_ = join.sketches.select("id", "n", "d1", "d2")
    some = rows_.where("n > 0").join(of_set, ["d1", "d2"]).select("id", "n", "component")
    none = rows_.where("n = 0").select("id", "n", F.col("id").alias("component"))
    return some.unionByName(none).select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
