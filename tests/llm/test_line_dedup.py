from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tallyline.llm.line_dedup import dedup_lines, held_by, twice_filter

STRIP = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(STRIP))


def plain(rows, least_chars=20, least_docs=3):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least_chars:
                holders[key_of(line)].add(doc)
    rank = lambda d: -(10**18) if d is None else d
    keeper = {k: max(d, key=rank) for k, d in holders.items() if len(d) >= least_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if keeper.get(key_of(x), doc) == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def found(frame):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in frame.collect()), key=str)


LINES = [f"a line of boilerplate, number {i}, with ÄÖ" for i in range(12)] + ["short", "", "x" * 19, "é" * 20, "Y" * 20]


def sample(n, seed):
    random.seed(seed)
    rows = []
    for i in range(n):
        lines = [random.choice(LINES) for _ in range(random.randrange(0, 9))]
        rows.append((i, "\n".join(random.choice([x, x.upper(), f" \t{x}\r", x]) for x in lines)))
    return rows


@pytest.mark.parametrize("bits", [1 << 20, 1 << 28])
def test_equals_plain(docs, bits):
    rows = sample(200, 1) + [(500, None), (501, ""), (502, "\n\n"), (503, ("word " * 40_000) + "\n" + LINES[0])]
    assert found(dedup_lines(docs(rows), most_bits=bits)) == plain(rows)


def test_repeated_rows_null_ids_and_ties(docs):
    rows = [(1, LINES[0]), (1, LINES[0]), (2, LINES[0]), (3, LINES[1]), (None, LINES[0]), (None, LINES[0]), (4, LINES[1])]
    assert found(dedup_lines(docs(rows))) == plain(rows)
    # two rows of one document and one more are two documents only
    assert all(r[3] == 0 for r in found(dedup_lines(docs(rows[:3]))))


def test_only_blanks_and_ascii_letters_are_folded(docs):
    nbsp = [(i, " a line of twenty signs") for i in range(2)] + [(5, "a line of twenty signs")]
    upper = [(i, "É" + "x" * 20) for i in range(2)] + [(5, "é" + "x" * 20)]
    for rows in (nbsp, upper):
        assert all(r[3] == 0 for r in found(dedup_lines(docs(rows))))


def test_empty_and_clashing_columns(docs, clashing):
    assert dedup_lines(docs([])).collect() == []
    rows = sample(30, 2)
    frame = clashing(docs(rows))
    result = dedup_lines(frame)
    assert result.columns == [*frame.columns, "n_lines", "n_dropped"]
    assert found(result) == plain(rows)
    assert {r["row"] for r in result.collect()} == {"own row"}


def test_filter_has_no_false_negative(docs):
    rows = sample(120, 3)
    twice = twice_filter(docs(rows).repartition(7).select("text"), 20, 1)
    holders = defaultdict(set)
    import xxhash

    for doc, text in rows:
        for line in text.split("\n"):
            holders[key_of(line)].add(doc)
    often = [k for k, d in holders.items() if len(d) >= 2 and len(k) >= 20]
    hashes = np.array([xxhash.xxh3_64_intdigest(k.encode()) for k in often], np.uint64)
    assert held_by(twice, hashes).all()
    once = np.random.default_rng(0).integers(0, 2**63, 2000).astype(np.uint64)
    assert held_by(twice, once).mean() < 0.01
