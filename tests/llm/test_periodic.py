from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tallyline.llm.periodic import periodic_runs, runs_of, surviving


def runs_by_hand(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed_by_hand(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def sequence(rng):
    out, n = [], rng.choice([0, 1, 11, 12, 13, 40, 120, 400])
    while len(out) < n:
        kind = rng.random()
        if kind < 0.4:
            period = [rng.randrange(6) for _ in range(rng.randrange(1, 40))]
            out += (period * rng.randrange(1, 6))[: rng.randrange(1, 150)]
        elif kind < 0.8:
            out += [rng.randrange(rng.choice([2, 3, 100])) for _ in range(rng.randrange(30))]
        else:
            out += [1000 + len(out) + j for j in range(3)]
    return out


def found_in(documents, least=12):
    codes = np.array([w for d in documents for w in d], np.int64)
    counts = np.array([len(d) for d in documents], np.int64)
    first = np.cumsum(counts) - counts
    out = [[] for _ in documents]
    for doc, start, end, period in runs_of(codes, counts, least).tolist():
        out[doc].append((start - first[doc], end - start, period))
    return out


@pytest.mark.parametrize("least", [12, 4, 30])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(120):
        documents = [sequence(rng) for _ in range(rng.randrange(1, 6))]
        if any(documents):
            assert found_in(documents, least) == [runs_by_hand(d, least) for d in documents]


def test_splitting_keeps_every_run_and_ends_stable():
    rng = random.Random(5)
    for _ in range(60):
        words = sequence(rng)
        if not words:
            continue
        segments = surviving(np.array(words, np.int64), np.array([len(words)]), 12)
        for lo, hi in segments:
            assert hi - lo >= 12 and all(words[lo:hi].count(w) > 1 for w in set(words[lo:hi]))
        for start, length, _ in runs_by_hand(words):
            assert any(lo <= start and start + length <= hi for lo, hi in segments)


def test_splits_that_peel_one_word_at_a_time():
    """A word is single only after its neighbour left: more rounds than those over all segments."""
    words = [w for i in range(4000) for w in ((i, i + 1) if i % 2 else (i + 1, i))]
    assert found_in([words, [7, 8, 9] * 5]) == [[], [(0, 15, 3)]]


def test_one_word_for_ever():
    assert found_in([[3] * 300_000, [1, 2] * 100_000]) == [[(0, 300_000, 1)], [(0, 200_000, 2)]]


TEXT = "one two three one two three one two three one two three one end"


def test_documents(docs, clashing):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{w}" for w in sequence(rng))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, " \t\r\n\x0b\x0c "), (103, f" {TEXT}\n"), (104, TEXT), (104, TEXT), (None, TEXT)]
    rows += [(105, "a\x1cb c　d é " * 20), (106, "word " * 200_000)]
    frame = clashing(docs(rows))
    got = periodic_runs(frame)
    assert got.columns == [*frame.columns, "n_words", "runs", "collapsed"]
    wanted = []
    for doc, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        runs = runs_by_hand(words) if len(words) < 10_000 else [(0, len(words), 1)]
        kept = collapsed_by_hand(words, runs) if len(words) < 10_000 else "word"
        wanted.append((doc, len(words), runs, kept))
    mine = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()]
    assert sorted(mine, key=str) == sorted(wanted, key=str)


def test_empty_table(docs):
    assert periodic_runs(docs([])).collect() == []


def test_columns_of_the_new_names_are_replaced(docs):
    found = periodic_runs(periodic_runs(docs([(1, TEXT)]))).first()
    assert found["n_words"] == 14 and [tuple(r) for r in found["runs"]] == [(0, 13, 3)] and found["collapsed"] == "one two three end"
