from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyline.llm.components import components
from tallyline.llm.simhash import block_meetings, linked, one_per_group, simhash_groups, trie_blocks, turns


def fingerprint(text, size=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups_of(prints, budget):
    """Smallest index reachable, for every index, by brute force."""
    values = np.array(prints, np.uint64)
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= budget):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def clustered(n, seed):
    """Fingerprints in chains and dense balls, some alone."""
    random.seed(seed)
    out = {0, (1 << 64) - 1, 1 << 63}
    while len(out) < n:
        value = random.getrandbits(64)
        for _ in range(random.choice([1, 1, 2, 30])):
            out.add(value)
            for _ in range(random.randrange(1, 5)):
                value ^= 1 << random.randrange(64)
    return sorted(out)[:n]


@pytest.mark.parametrize(("budget", "block", "many"), [(3, 4, 8192), (3, 64, 8192), (0, 16, 8192), (5, 16, 8), (20, 64, 8192), (3, 1 << 14, 8192)])
def test_trie_join_equals_brute_force(spark, budget, block, many):
    prints = clustered(700, budget)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "fp long").repartition(5)
    roots = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in linked(frame, budget, block, many).collect()}
    wanted = groups_of(prints, budget)
    sizes = {g: wanted.count(g) for g in set(wanted)}
    assert set(roots) == {prints[i] for i, g in enumerate(wanted) if sizes[g] > 1}
    mine = {}
    for i, g in enumerate(wanted):
        if sizes[g] > 1:
            mine.setdefault(g, set()).add(roots[prints[i]])
    assert all(len(r) == 1 for r in mine.values()) and len({next(iter(r)) for r in mine.values()}) == len(mine)


def test_bit_orders_turn_back_and_cover_all_budgets():
    values = np.random.default_rng(3).integers(0, 1 << 64, 500, np.uint64, endpoint=False)
    for budget in (0, 1, 3, 5, 15, 20):
        for way in turns(budget):
            assert (way.back(way.read(values)) == values).all()
            assert sorted(b for a, w in way.chunks for b in range(a, a + w)) == list(range(64))
            least, most = way.bounds(budget)
            assert (least <= np.maximum(most, 0)).all() and least[64] == way.earlier


def test_few_blocks_travel(spark):
    """Random fingerprints in hundreds of blocks: what meets another block does so at the edge of a task only."""
    values = np.unique(np.random.default_rng(4).integers(-(1 << 63), 1 << 63, 20_000, np.int64))
    frame = spark.createDataFrame([(int(v),) for v in values], "fp long")
    blocks = trie_blocks(frame, turns(3), len(values), 256, 1 << 15)
    n, tasks = blocks.count(), blocks.rdd.getNumPartitions()
    assert n > 250
    assert block_meetings(blocks, turns(3), 3).count() <= 8 * tasks


TEXT = "the quick brown fox jumps over the lazy dog and runs away from the old grey wolf in the deep dark forest near town"


def test_documents(docs, clashing):
    random.seed(5)
    rows = [(i, " ".join(random.choice(TEXT.split()) for _ in range(random.randrange(1, 60)))) for i in range(10, 60)]
    rows += [(1, None), (2, ""), (3, " \t\r\n"), (4, TEXT), (5, TEXT.upper()), (6, TEXT + " again"), (7, "one two"), (8, "ONE  two"), (9, " ")]
    rows += [(4, TEXT), (None, TEXT), (99, "word " * 200_000)]
    got = sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash_groups(clashing(docs(rows))).collect()), key=str)
    prints = [fingerprint(t) for _, t in rows]
    groups = groups_of(prints, 3)
    least = {}
    for (doc, _), g in zip(rows, groups, strict=True):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    assert got == sorted(((d, p, least.get(g)) for (d, _), p, g in zip(rows, prints, groups, strict=True)), key=str)
    kept = {r["doc_id"] for r in one_per_group(docs(rows)).collect()}
    assert kept == {None, *least.values()}
    frame = clashing(docs(rows[:3]))
    assert one_per_group(frame).columns == frame.columns


def test_empty_table(docs):
    assert simhash_groups(docs([])).collect() == []
    assert one_per_group(docs([])).collect() == []


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, 200 + i) for i in range(1, 60)] + [(300 + i, 399) for i in range(50)]
    edges += [(500 + i, 500 + (i + 1) % 37) for i in range(37)] + [(7, 7), (900, 901), (901, 900)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).select("node", "root").collect())
    assert got == {
        **{i: 0 for i in range(101)}, **{200 + i: 200 for i in range(60)}, **{300 + i: 300 for i in range(50)}, 399: 300,
        **{500 + i: 500 for i in range(37)}, 900: 900, 901: 900,
    }


def test_hot_fingerprint_is_one_node(spark, docs):
    rows = [(i, TEXT) for i in range(400)] + [(1000 + i, f"other text number {i} of many words {i * 7}") for i in range(50)]
    groups = simhash_groups(docs(rows))
    assert groups.where(F.col("doc_id") < 400).select("component_id").distinct().collect() == [(0,)]
