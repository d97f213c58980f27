from __future__ import annotations

import heapq
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyline.llm import token_files
from tallyline.llm.bpe import default_path
from tallyline.llm.token_files import STRIDE, canonical, code_lengths, pack_bits, read_token_files, unpack_bits, write_texts, write_token_files
from tallyline.session import new_run_dir


def huffman_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    return cost


@pytest.mark.parametrize("seed", range(4))
def test_lengths_are_optimal_and_a_prefix_code(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 1000, 500)
    lengths = code_lengths(counts, 30)
    assert ((lengths > 0) == (counts > 0)).all()
    assert sum(2.0 ** -int(n) for n in lengths if n) == 1.0
    assert int((counts * lengths).sum()) == huffman_cost(counts)


def test_lengths_are_limited():
    counts = np.array([2**min(i, 40) for i in range(60)], np.int64)
    lengths = code_lengths(counts)
    assert lengths.max() <= 16 and sum(2.0 ** -int(n) for n in lengths) <= 1.0
    assert code_lengths(np.ones(1 << 16, np.int64)).tolist() == [16] * (1 << 16)
    with pytest.raises(ValueError, match="do not fit"):
        code_lengths(np.ones((1 << 16) + 1, np.int64))
    assert code_lengths(np.array([0, 5])).tolist() == [0, 1]
    assert code_lengths(np.zeros(3, np.int64)).tolist() == [0, 0, 0]


@pytest.mark.parametrize("n", [1, 2, STRIDE - 1, STRIDE, STRIDE + 1, 10 * STRIDE + 3, 64 * STRIDE, 130 * STRIDE + 7])
def test_bits_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.003, n), 9000).astype(np.int32)
    lengths = code_lengths(np.bincount(ids, minlength=9001))
    codes, to_id, to_length = canonical(lengths)
    bits, checkpoints = pack_bits(ids, lengths, codes)
    assert unpack_bits(bits, checkpoints, n, to_id, to_length).tolist() == ids.tolist()
    if n > STRIDE:  # a stretch alone, from its checkpoint
        assert unpack_bits(bits, checkpoints[1:2], min(STRIDE, n - STRIDE), to_id, to_length).tolist() == ids[STRIDE : 2 * STRIDE].tolist()


def test_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "_BLOCK_TOKENS", 50)
    rng = np.random.default_rng(1)
    rows = [(int(d), rng.integers(0, 70_000, int(rng.integers(0, 40))).tolist()) for d in rng.permutation(200)]
    rows += [(7, [5, 6]), (7, [5, 6]), (None, [9]), (-5, list(range(3000)))]
    folder = new_run_dir(spark, "files")
    write_token_files(spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(6), folder)
    got = read_token_files(spark, folder).collect()
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in ordered])])[:-1].tolist()
    names = [r["doc_id"] for r in ordered]
    assert names[0] is None and names[1:] == sorted(names[1:])
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == sorted((str(d), [*ids, 1]) for d, ids in rows)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["n_tokens"] == len(r["ids"]) for r in got)


def test_empty(spark):
    folder = new_run_dir(spark, "files")
    write_token_files(spark.createDataFrame([], "doc_id long, ids array<int>"), folder)
    assert read_token_files(spark, folder).collect() == []


def test_texts_are_written_as_the_library_encodes_them(spark, docs, clashing, monkeypatch):
    monkeypatch.setattr(token_files, "_BLOCK_TOKENS", 500)
    rng = np.random.default_rng(3)
    vocabulary = ["the", "House", "of", "élan", "日本", "x" * 60, "3.14", "don't", "\u00a0", "😀"]
    rows = [(int(d), " ".join(rng.choice(vocabulary, int(rng.integers(0, 50))))) for d in rng.permutation(150)]
    rows += [(500, None), (501, ""), (502, " \n\t "), (7, "twice"), (7, "twice"), (None, "no id"), (503, "long text of words " * 20_000)]
    folder = new_run_dir(spark, "files")
    write_texts(clashing(docs(rows)).repartition(5), folder)
    library = Tokenizer.from_file(default_path())
    wanted = [(d, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in rows]
    got = sorted(read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == sorted(wanted, key=str)
    names = [r["doc_id"] for r in got]
    assert names[0] is None and names[1:] == sorted(names[1:])
    assert [r["start"] for r in got] == np.concatenate([[0], np.cumsum([len(r["ids"]) for r in got])])[:-1].tolist()
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got)
