"""Approximate nearest neighbours: one navigable small-world graph per shard, shard results merged.

1. Equal vectors become one node with the smallest ids that have them (as many as a query can return).
2. Nodes are dealt to shards of bounded size by a hash of their vector.  Each shard builds its graph alone and is
   stored as one row of flat arrays: vectors, neighbour table of the ground layer, tables of the upper layers.
3. Queries travel in blocks to every shard; each shard returns its nearest, and the nearest of these are kept.
   Where there are many queries, groups of blocks work on copies of a shard's row side by side.

Distances inside the graph are single precision; what a shard returns is measured again in double precision on the
given vectors, so scores and their order are exact for what was found.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import batches, cut, partitions


@dataclass(frozen=True)
class Settings:
    """``links`` neighbours on upper layers, twice as many on the ground; breadths of search while building and asking."""

    shard_rows: int = 4096
    links: int = 16
    build_breadth: int = 64
    breadth: int = 128
    query_block: int = 512
    blocks_at_once: int = 32


def _mixed(nodes: np.ndarray, of: int) -> np.ndarray:
    """An order of equally near nodes that differs from node to node, so that no node is left out by all others."""
    shift = np.uint64(of * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (nodes.astype(np.uint64) + shift) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)


class Graph:
    """A hierarchical navigable small-world graph over the rows of ``vectors``."""

    def __init__(self, vectors: np.ndarray, links: int) -> None:
        self.x = vectors.astype(np.float32)
        self.links = links
        n = len(vectors)
        self.ground = np.full((n, 2 * links + 1), -1, np.int32)  # the last one is for nodes that no other leads to
        self.upper: list[tuple[np.ndarray, np.ndarray]] = []  # row of each node (-1: not there), neighbours by row
        self.entry = 0
        self.seen = np.zeros(n, np.int32)
        self.turn = 0

    def neighbours(self, layer: int, node: int) -> np.ndarray:
        if layer == 0:
            row = self.ground[node]
        else:
            rows, table = self.upper[layer - 1]
            row = table[rows[node]]
        return row[row >= 0]

    def set_neighbours(self, layer: int, node: int, found: np.ndarray) -> None:
        if layer == 0:
            row = self.ground[node, :-1]
        else:
            rows, table = self.upper[layer - 1]
            row = table[rows[node]]
        row[: len(found)] = found
        row[len(found) :] = -1

    def distances(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        apart = self.x[nodes] - q
        return np.einsum("ij,ij->i", apart, apart)

    def descend(self, q: np.ndarray, node: int, layer: int) -> int:
        """The nearest node that greedy steps on one layer reach."""
        best = float(self.distances(q, np.array([node]))[0])
        while True:
            near = self.neighbours(layer, node)
            if not len(near):
                return node
            d = self.distances(q, near)
            i = int(d.argmin())
            if d[i] >= best:
                return node
            best, node = float(d[i]), int(near[i])

    def search(self, q: np.ndarray, entry: int, breadth: int, layer: int) -> list[tuple[float, int]]:
        """The nearest nodes that a best-first search of this breadth finds on one layer, nearest first."""
        self.turn += 1
        seen, turn = self.seen, self.turn
        first = float(self.distances(q, np.array([entry]))[0])
        open_, best = [(first, entry)], [(-first, entry)]
        seen[entry] = turn
        while open_:
            d, node = heapq.heappop(open_)
            if len(best) >= breadth and d > -best[0][0]:
                break
            near = self.neighbours(layer, node)
            near = near[seen[near] != turn]
            if not len(near):
                continue
            seen[near] = turn
            for e, other in zip(self.distances(q, near).tolist(), near.tolist(), strict=True):
                if len(best) < breadth:
                    heapq.heappush(best, (-e, other))
                    heapq.heappush(open_, (e, other))
                elif e < -best[0][0]:
                    heapq.heapreplace(best, (-e, other))
                    heapq.heappush(open_, (e, other))
        return sorted((-d, node) for d, node in best)

    def diverse(self, ds: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` of the nodes (nearest first), none closer to one kept before than to the origin of ``ds``;
        then the nearest of the rest, so that no link is wasted."""
        if len(nodes) <= most:
            return nodes
        x = self.x[nodes]
        square = np.einsum("ij,ij->i", x, x)
        apart = square[:, None] + square[None, :] - 2 * (x @ x.T)
        shaded = np.zeros(len(nodes), bool)
        kept: list[int] = []
        for i in range(len(nodes)):
            if not shaded[i]:
                kept.append(i)
                if len(kept) == most:
                    break
                shaded |= apart[i] < ds
        if len(kept) < most:
            rest = np.ones(len(nodes), bool)
            rest[kept] = False
            kept += np.flatnonzero(rest)[: most - len(kept)].tolist()
        return nodes[kept]

    def link(self, layer: int, node: int, other: int) -> None:
        """Add a link, and choose again where the row is full."""
        near = self.neighbours(layer, node)
        most = 2 * self.links if layer == 0 else self.links
        if len(near) < most:
            self.set_neighbours(layer, node, np.append(near, np.int32(other)))
            return
        nodes = np.append(near, np.int32(other))
        ds = self.distances(self.x[node], nodes)
        order = np.lexsort((_mixed(nodes, node), ds))
        self.set_neighbours(layer, node, self.diverse(ds[order], nodes[order], most))

    def build(self, breadth: int, seed: int) -> Graph:
        n = len(self.x)
        heights = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(self.links)).astype(int)
        for layer in range(1, int(heights.max(initial=0)) + 1):
            members = np.flatnonzero(heights >= layer)
            rows = np.full(n, -1, np.int32)
            rows[members] = np.arange(len(members))
            self.upper.append((rows, np.full((len(members), self.links), -1, np.int32)))
        top = int(heights[0]) if n else 0
        for node in range(1, n):
            q, height, at = self.x[node], int(heights[node]), self.entry
            for layer in range(top, height, -1):
                at = self.descend(q, at, layer)
            for layer in range(min(top, height), -1, -1):
                found = self.search(q, at, breadth, layer)
                ds = np.array([d for d, _ in found], np.float32)
                nodes = np.array([i for _, i in found], np.int32)
                order = np.lexsort((_mixed(nodes, node), ds))
                chosen = self.diverse(ds[order], nodes[order], self.links)
                self.set_neighbours(layer, node, chosen)
                for other in chosen.tolist():
                    self.link(layer, other, node)
                at = found[0][1]
            if height > top:
                top, self.entry = height, node
        self.reach_all()
        return self

    def reach_all(self) -> None:
        """Nodes that no path from the entry leads to get a link from one that is reached, near ones first."""
        reached = np.zeros(len(self.x), bool)

        def spread(front: np.ndarray) -> None:
            while len(front):
                reached[front] = True
                near = np.unique(self.ground[front])
                front = near[(near >= 0) & ~reached[near]]

        spread(np.array([self.entry], np.int64)[: len(self.x)])
        for node in np.flatnonzero(~reached).tolist():
            if not reached[node]:
                able = np.flatnonzero(reached & (self.ground[:, -1] < 0))
                known = np.intersect1d(able, self.ground[node])
                able = known if len(known) else able
                self.ground[able[self.distances(self.x[node], able).argmin()], -1] = node
                spread(np.array([node]))

    def ask(self, q: np.ndarray, breadth: int) -> np.ndarray:
        at = self.entry
        for layer in range(len(self.upper), 0, -1):
            if self.upper[layer - 1][0][at] >= 0:
                at = self.descend(q, at, layer)
        return np.array([i for _, i in self.search(q, at, breadth, 0)], np.int64)


_INDEX_SQL = (
    "dim int, shard int, kind int, part int, n int, entry int, vectors binary, members binary, member_counts binary, "
    "ground binary, upper_nodes binary, upper_counts binary, upper binary"
)
_INDEX = pa.schema(
    [
        ("dim", pa.int32()), ("shard", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("n", pa.int32()),
        ("entry", pa.int32()), ("vectors", pa.binary()), ("members", pa.binary()), ("member_counts", pa.binary()),
        ("ground", pa.binary()), ("upper_nodes", pa.binary()), ("upper_counts", pa.binary()), ("upper", pa.binary()),
    ]
)
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _built(parts: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (dim, shard): one graph held at a time."""

    def rows() -> Iterator[tuple]:
        held: tuple[int, int] | None = None
        vectors: list[np.ndarray] = []
        members: list[list[int]] = []
        for part in parts:
            columns = (part.column(n).to_pylist() for n in ("dim", "shard", "ids"))
            flat = part.column("vector").flatten().to_numpy()
            at = 0
            for dim, shard, ids in zip(*columns, strict=True):
                if held != (dim, shard):
                    if held:
                        yield row(*held, vectors, members)
                    held, vectors, members = (dim, shard), [], []
                vectors.append(flat[at : at + dim].copy())
                members.append(ids)
                at += dim
        if held:
            yield row(*held, vectors, members)

    def row(dim: int, shard: int, vectors: list[np.ndarray], members: list[list[int]]) -> tuple:
        x = np.stack(vectors)
        graph = Graph(x, settings.links).build(settings.build_breadth, seed=shard)
        uppers = [(np.flatnonzero(rows >= 0).astype(np.int32), table) for rows, table in graph.upper]
        empty = [np.zeros(0, np.int32)]
        return (
            dim, shard, 0, 0, len(x), graph.entry, x.tobytes(),
            np.concatenate([np.array(m, np.int64) for m in members]).tobytes(),
            np.array([len(m) for m in members], np.int64).tobytes(),
            graph.ground.tobytes(),
            np.concatenate(empty + [nodes for nodes, _ in uppers]).tobytes(),
            np.array([len(nodes) for nodes, _ in uppers], np.int64).tobytes(),
            np.concatenate(empty + [table.ravel() for _, table in uppers]).tobytes(),
        )

    yield from batches(rows(), _INDEX)


def _graph(row: dict, links: int) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """A stored shard again: graph, exact vectors, members and where each node's members start."""
    x = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], row["dim"])
    graph = Graph(x, links)
    graph.ground = np.frombuffer(row["ground"], np.int32).reshape(row["n"], 2 * links + 1)
    nodes, tables = np.frombuffer(row["upper_nodes"], np.int32), np.frombuffer(row["upper"], np.int32).reshape(-1, links)
    at = 0
    for count in np.frombuffer(row["upper_counts"], np.int64).tolist():
        rows = np.full(row["n"], -1, np.int32)
        rows[nodes[at : at + count]] = np.arange(count)
        graph.upper.append((rows, tables[at : at + count]))
        at += count
    graph.entry = row["entry"]
    counts = np.frombuffer(row["member_counts"], np.int64)
    return graph, x, np.frombuffer(row["members"], np.int64), np.concatenate([[0], np.cumsum(counts)])


def _blocked(parts: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Queries of one dimension in blocks: ids in ``members``, vectors in ``vectors``."""

    def rows() -> Iterator[tuple]:
        held: dict[int, tuple[list[int], list[list[float]]]] = {}
        for part in parts:
            for query, vector in zip(*(c.to_pylist() for c in part.columns), strict=True):
                ids, vectors = held.setdefault(len(vector), ([], []))
                ids.append(query)
                vectors.append(vector)
                if len(ids) == size:
                    yield one(len(vector), *held.pop(len(vector)))
        for dim, (ids, vectors) in held.items():
            yield one(dim, ids, vectors)

    def one(dim: int, ids: list[int], vectors: list[list[float]]) -> tuple:
        packed = np.array(ids, np.int64).tobytes()
        return dim, 0, 1, 0, len(ids), 0, np.array(vectors, np.float64).tobytes(), packed, *[None] * 5

    yield from batches(rows(), _INDEX)


def _asked(parts: Iterator[pa.RecordBatch], k: int, settings: Settings) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (dim, shard, part, kind): a shard's row, then the query blocks it has to answer."""

    def rows() -> Iterator[tuple]:
        held, key = None, None
        for part in parts:
            for row in part.to_pylist():
                if row["kind"] == 0:
                    held, key = _graph(row, settings.links), (row["dim"], row["shard"], row["part"])
                elif held is not None and key == (row["dim"], row["shard"], row["part"]):
                    queries = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], row["dim"])
                    for query, q in zip(np.frombuffer(row["members"], np.int64).tolist(), queries, strict=True):
                        yield from nearest(*held, query, q)

    def nearest(graph: Graph, x: np.ndarray, members: np.ndarray, starts: np.ndarray, query: int, q: np.ndarray) -> list[tuple]:
        nodes = graph.ask(q.astype(np.float32), max(settings.breadth, 2 * k))
        apart = x[nodes] - q
        scores = np.sqrt((apart * apart).sum(axis=1))
        found = []
        # k + 1 nodes are enough without the query's own; all that are as near as the last of them count, so that equal
        # scores are cut by id
        far = np.partition(scores, min(k, len(scores) - 1))[min(k, len(scores) - 1)] if len(scores) else 0.0
        for i in np.flatnonzero(scores <= far):
            node = int(nodes[i])
            own = members[starts[node] : starts[node + 1]]
            found += [(float(scores[i]), m) for m in own.tolist() if m != query]
        return [(query, m, d) for d, m in sorted(found)[:k]]

    yield from batches(rows(), _FOUND)


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, empty or zero, every component a finite number."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def build_index(vectors: DataFrame, k: int, settings: Settings, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The shards of an index, one row of flat arrays each; every usable row is in it.

    Equal vectors share a node that names the ``k + 1`` smallest ids among them: a query returns at most ``k``.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")) & F.col("id").isNotNull()).distinct()
    order = Window.partitionBy("vector").orderBy("id")
    first = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    nodes = cut(first.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    shards = max(1, -(-nodes.count() // settings.shard_rows))
    dealt = nodes.select(
        F.size("vector").alias("dim"),
        F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"),
        F.xxhash64("vector").alias("place"),
        "vector",
        "ids",
    )
    ordered = dealt.repartition(max(shards, partitions(spark)), "dim", "shard").sortWithinPartitions("dim", "shard", "place", "ids")
    return cut(ordered.select("dim", "shard", "vector", "ids").mapInArrow(partial(_built, settings=settings), _INDEX_SQL))


def search(index: DataFrame, queries: DataFrame, k: int, settings: Settings) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each query (query_id long, vector array<double>)."""
    spark = index.sparkSession
    asked = queries.where(usable(F.col("vector"))).select("query_id", "vector").distinct()
    groups = max(1, -(-asked.count() // (settings.query_block * settings.blocks_at_once)))
    blocks = asked.repartition(groups, "query_id").mapInArrow(partial(_blocked, size=settings.query_block), _INDEX_SQL)
    shards = index.select("dim", "shard").distinct()
    to_shards = (
        blocks.withColumn("part", F.pmod(F.xxhash64("members"), F.lit(groups)).cast("int"))
        .drop("shard")
        .join(shards, "dim")
        .select(index.columns)
    )
    copies = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select(index.columns)
    keys = ("dim", "shard", "part")
    together = copies.unionByName(to_shards).repartition(max(partitions(spark), groups), *keys)
    found = together.sortWithinPartitions(*keys, "kind").mapInArrow(
        partial(_asked, k=k, settings=settings), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def neighbours(
    vectors: DataFrame, queries: Column, k: int = 10, settings: Settings = Settings(), vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of every row that ``queries`` selects, itself left out.

    Nearness is Euclidean; equal scores go to the smaller id.  Null, empty and zero vectors, vectors with a null or
    non-finite component and rows without an id take no part.  Vectors of different lengths are not compared.
    Repeated rows count once; fewer than ``k`` candidates give fewer rows; an empty table gives none.
    """
    index = build_index(vectors, k, settings, vec_id, vector)
    asked = vectors.where(queries).select(
        F.col(vec_id).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    return search(index, asked, k, settings)
