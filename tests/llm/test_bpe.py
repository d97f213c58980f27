from __future__ import annotations

import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyline.llm import bpe
from tallyline.llm.bpe import decode, default_path, encode, grow, shrink

TEXTS = [
    None,
    "",
    " \t\n",
    "Hello  World's <|endoftext|>x don't 123 ab12 ...",
    "a<|startoftext|>b <|END|> <|endoftext|><|endoftext|>",
    "ÉÇ été naïve ﬁn Ⅷ ½ ² İstanbul ΑΣ ΌΔΟΣ ß ẞ",
    "é ạ̈ 가 क़",
    "nbsp joins and　wide line\u0085next\x1cfile\x1fend",
    "zero​width ﻿bom 漢字かな 🙂👩‍👩‍👧 \U0001f1e9\U0001f1ea",
    "x" * 5000,
    "tab\tand\x0bvertical\x0cfeed\r\nend",
    "\x00nul \x7f",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_path())


def wanted(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("block", [1, 1 << 24])
def test_equals_the_library(docs, library, monkeypatch, clashing, block):
    monkeypatch.setattr(bpe, "_AT_ONCE", 7)
    monkeypatch.setattr(bpe, "_BLOCK_BYTES", block)
    random.seed(3)
    words = " ".join(t for t in TEXTS if t).split(" ")
    texts = TEXTS + [" ".join(random.choice(words) for _ in range(random.randrange(40))) for _ in range(60)]
    rows = [*enumerate(texts), (3, TEXTS[3]), (3, TEXTS[3]), (None, TEXTS[3]), (1000, "long text " * 50_000)]
    got = decode(encode(clashing(docs(rows)).repartition(5))).collect()
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in got) == sorted((str(i), *wanted(library, t)) for i, t in rows)


def test_tokenizers_that_keep_white_space_are_refused(docs):
    whole = public_tokenizers.path("byte_bpe_50k.json")
    with pytest.raises(ValueError, match="one by one"):
        encode(docs([(1, "Hello world")]), whole)
    with pytest.raises(ValueError, match="one by one"):
        decode(docs([]).selectExpr("doc_id", "array(1) AS ids"), whole)


def test_another_tokenizer_that_cuts_at_white_space(docs, tmp_path):
    """Without a normaliser and with a cut of its own, the tokenizer sees whole words."""
    file = json.loads(Tokenizer.from_file(default_path()).to_str())
    file["normalizer"] = {"type": "Lowercase"}
    file["pre_tokenizer"]["pretokenizers"][0] = {"type": "WhitespaceSplit"}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(file))
    other = Tokenizer.from_file(str(path))
    texts = [t for t in TEXTS if t and "\x00" not in t]
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in decode(encode(docs(list(enumerate(texts))), str(path)), str(path)).collect()}
    assert got == {i: wanted(other, t) for i, t in enumerate(texts)}


def test_empty_table(docs):
    assert encode(docs([])).collect() == []


def test_decode_leaves_out_what_it_does_not_know(spark, library):
    rows = [(1, [320, 49407, 49408, -1, 321, None]), (2, []), (3, None), (4, [0])]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>").withColumnRenamed("doc_id", "decoded_")
    got = {r[0]: r["decoded"] for r in decode(frame).collect()}
    assert got == {1: library.decode([320, 49407, 321], skip_special_tokens=False), 2: "", 3: "", 4: library.decode([0])}


def test_shrink_round_trip():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2097151, 2097152, (1 << 28) - 1])
    assert grow(shrink(values)).tolist() == values.tolist()
    assert grow(shrink(np.zeros(0, np.int64))).tolist() == []
