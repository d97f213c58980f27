from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyline.llm.minhash import group_keys, minhash_groups, shingle_sets


def shingles(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} or ({" ".join(words)} if words else set())


def by_hand(rows, size=5, percent=80):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, s in enumerate(sets):
        both = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    both[j] = both.get(j, 0) + 1
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    parts = [(doc, len(s), doc if not s else least.get(find(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]
    return sorted(((doc, n, c, doc == c) for doc, n, c in parts), key=str)


def found(frame, **options):
    return sorted((tuple(r) for r in minhash_groups(frame, **options).collect()), key=str)


def corpus(seed, n, vocabulary=4000):
    """Families of a base text and variants at all distances, chains, shared passages, and texts that stand alone."""
    rng = random.Random(seed)

    def words(k):
        return [f"w{rng.randrange(vocabulary)}" for _ in range(k)]

    passages = [words(60) for _ in range(3)]
    texts = []
    while len(texts) < n:
        base = words(rng.randrange(3, 160))
        if rng.random() < 0.3:
            base += rng.choice(passages)
        texts.append(base)
        for _ in range(rng.choice([0, 0, 1, 3, 25])):
            variant = list(rng.choice([base, texts[-1]]))
            for _ in range(rng.randrange(0, 1 + len(variant) // 25)):
                variant[rng.randrange(len(variant))] = f"w{rng.randrange(vocabulary)}"
            texts.append(variant)
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts[:n])]


@pytest.mark.parametrize(("seed", "block"), [(1, 2 << 20), (2, 4000)])
def test_groups_equal_brute_force(spark, docs, seed, block):
    rows = corpus(seed, 600)
    assert found(docs(rows).repartition(5), block_bytes=block) == by_hand(rows)


def test_one_large_family(docs):
    """Variants of one text at distances around the threshold: most are linked, some are not, some only by others."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(3000)}" for _ in range(150)]
    rows = []
    for i in range(400):
        variant = list(base)
        for _ in range(rng.randrange(1, 9)):
            variant[rng.randrange(150)] = f"v{rng.randrange(3000)}"
        rows.append((i, " ".join(variant)))
    assert found(docs(rows).repartition(4), block_bytes=60_000) == by_hand(rows)


TEXT = "the quick brown fox jumps over the lazy dog and runs away from the old grey wolf in the deep dark forest near town"


def test_documents(docs, clashing):
    rows = [(1, None), (2, ""), (3, " \t\r\n"), (10, TEXT), (11, TEXT.upper()), (12, TEXT + " again"), (13, "one two"), (14, "ONE  two"), (15, "one")]
    rows += [(16, "one one"), (17, "a a a a a a a a"), (18, "a a a a a"), (10, TEXT), (None, TEXT), (None, "nobody has this text at all"), (None, "")]
    rows += [(10, "another text under a known id"), (20, "word " * 200_000), (21, " ".join(f"x{i}" for i in range(100_000)))]
    rows += [(22, " ".join(f"x{i}" for i in range(95_000))), (23, "x\x1cy z　q É é a b c d"), (24, "x\x1cy z　q é é a b c d")]
    wanted = sorted((*r[:3], r[0] is None and r[2] is None or r[3]) for r in by_hand(rows) if r[0] is not None)
    got = found(clashing(docs(rows)))
    assert sorted(r for r in got if r[0] is not None) == wanted
    assert {r for r in got if r[0] is None} == {(None, 0, None, True), (None, 20, 10, False), (None, 2, None, True)}


def test_exact_copies_are_one_node(docs):
    rows = [(i, TEXT) for i in range(500)] + [(1000 + i, f"other text number {i} of many words {i * 7}") for i in range(50)]
    assert found(docs(rows)) == by_hand(rows)


def test_empty_tables(docs):
    assert found(docs([])) == []
    assert found(docs([(1, ""), (2, None)])) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_shorter_texts_never_equal_longer_ones():
    hashes, counts = shingle_sets(pa.array(["a b", "a b c d", "a", "a b c", None, "b a"]), 4)
    assert counts.tolist() == [1, 1, 1, 1, 0, 1] and len(set(hashes.tolist())) == 5


def test_keys_agree_as_often_as_similarity_says():
    rng = np.random.default_rng(0)
    agree = []
    for _ in range(200):
        whole = rng.integers(0, 1 << 63, 180, dtype=np.uint64)
        x, y = np.sort(whole[:162]), np.sort(whole[18:])
        keys = group_keys(np.concatenate([x, y]), np.array([162, 162]), 40, 3)
        agree.append((keys[0] == keys[1]).mean())
    assert abs(np.mean(agree) - (144 / 180) ** 3) < 0.02
