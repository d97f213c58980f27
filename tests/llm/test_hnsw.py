from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm.hnsw import Graph, Settings, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k):
    """Brute force over usable rows: {query: [(score, id)]}."""
    known = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if v and i is not None and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q, a in known.items():
        if q % 100 == 0:
            near = [(float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in known.items() if i != q and len(b) == len(a)]
            out[q] = sorted(near)[:k]
    return {q: n for q, n in out.items() if n}


def found(frame, k=10, settings=Settings()):
    got = defaultdict(list)
    for r in neighbours(frame, F.col("vec_id") % 100 == 0, k, settings).collect():
        got[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    assert all([x[0] for x in sorted(g)] == list(range(1, len(g) + 1)) for g in got.values())
    return {q: [(s, i) for _, s, i in sorted(g)] for q, g in got.items()}


def recall(got, wanted):
    hits = sum(len({i for _, i in got.get(q, [])} & {i for _, i in n}) for q, n in wanted.items())
    return hits / sum(len(n) for n in wanted.values())


@pytest.mark.parametrize("shard_rows", [300, 5000])
def test_recall(spark, shard_rows):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 24))
    rows = [(i, (centres[i % 12] + rng.standard_normal(24) * (0.2 if i % 3 else 1.0)).tolist(), 0) for i in range(2500)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got, wanted = found(frame, 10, Settings(shard_rows=shard_rows)), plain(rows, 10)
    assert recall(got, wanted) >= 0.97
    truth = {(q, i): s for q, n in plain(rows, 2500).items() for s, i in n}
    assert all(abs(truth[q, i] - s) < 1e-12 for q, g in got.items() for s, i in g)
    assert all(g == sorted(g) and len(g) == 10 for g in got.values())


def test_copies_ties_and_a_common_vector(spark):
    rng = np.random.default_rng(2)
    common = rng.standard_normal(8).tolist()
    rows = [(i, common if i % 3 == 0 else rng.standard_normal(8).tolist(), 0) for i in range(900)]
    rows += [(i, v, 1) for i, v, _ in rows[:50]]
    got = found(spark.createDataFrame(rows, SCHEMA), 5, Settings(shard_rows=100, query_block=2, blocks_at_once=1))
    wanted = plain(rows, 5)
    assert got[0] == wanted[0] == [(0.0, i) for i in (3, 6, 9, 12, 15)]
    assert recall(got, wanted) >= 0.97


def test_odd_vectors(spark):
    random.seed(1)
    fine = [(i, [random.random() for _ in range(4)], 0) for i in range(1, 60)]
    odd = [(0, [1.0, 0.5, 0.25, 0.0], 0), (100, None, 0), (200, [], 0), (300, [0.0] * 4, 0), (400, [1.0, None, 0.0, 0.0], 0),
           (500, [float("nan"), 1.0, 1.0, 1.0], 0), (600, [float("inf"), 1.0, 1.0, 1.0], 0), (700, [1.0, 2.0], 0), (800, [1.0, 2.5], 0), (None, [1.0, 1.0, 1.0, 1.0], 0)]
    rows = fine + odd
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows, 10)


def test_few_rows_empty_table_and_clashing(spark, clashing):
    assert found(spark.createDataFrame([], SCHEMA)) == {}
    assert found(spark.createDataFrame([(0, [1.0], 0)], SCHEMA)) == {}
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [4.0, 6.0], 0)]
    frame = clashing(spark.createDataFrame(rows, SCHEMA)).withColumns({"vector": F.lit(1), "shard": F.lit(1), "dim": F.lit(1)})
    assert found(frame) == {0: [(0.0, 1), (5.0, 2)]}


def test_graph_reaches_every_node():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.standard_normal((150, 6)), rng.standard_normal((150, 6)) * 1e-3 + 5])
    graph = Graph(x, 6).build(40, 0)
    assert all(graph.ask(v.astype(np.float32), 40)[0] == i for i, v in enumerate(x))


def test_equal_distances_go_to_the_smaller_ids(spark):
    """60 one-hot vectors: all as far from the query as each other."""
    rows = [(i, [float(j == n) for j in range(60)]) for n, i in enumerate([*range(1, 60), 100])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    for settings in (Settings(), Settings(shard_rows=16)):
        got = neighbours(frame, F.col("vec_id") == 100, 10, settings)
        assert [(r["rank"], r["vec_id"]) for r in got.orderBy("rank").collect()] == [(n, n) for n in range(1, 11)]


def test_every_node_is_reached_when_all_are_as_near():
    for n in (1, 2, 60, 700):
        graph = Graph(np.eye(n), 16).build(64, 0)
        assert len(graph.ask(np.eye(n, dtype=np.float32)[n // 2], n)) == n
