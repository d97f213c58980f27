from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyline.llm.fim import fill_in_middle, restored


def by_hand(doc, text, seed=1, plain=10, spm=20, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    one, two = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:one], units[one:two], units[two:]))
    p, s, m = marks
    if not text or any(x in text for x in marks) or h[2] % 100 >= 100 - plain:
        return doc, len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return doc, len(units), "spm", len(prefix), len(middle), f"{s}{suffix}{p}{prefix}{m}{middle}"
    return doc, len(units), "psm", len(prefix), len(middle), f"{p}{prefix}{s}{suffix}{m}{middle}"


COLUMNS = ("doc_id", "n_units", "form", "prefix_chars", "middle_chars", "output")


def texts(n):
    rng = random.Random(n)
    pieces = ["word", "Two", " ", "\n", "\x00", "é", "日本", "😀", "<", "<S", "P>", ">", "9", " ", "\x7f", "\x80", "﻿", "\U0010ffff"]
    return [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"seed": 7, "plain": 0, "spm": 50, "marks": ("[p]", "[s]", "[m]")}, {"plain": 100}, {"spm": 100}])
def test_against_a_plain_version(docs, clashing, options):
    rows = texts(300) + [(900, None), (901, ""), (902, "a <P> b"), (903, "a<S>"), (904, "<M>"), (905, "a"), (None, "no id at all")]
    rows += [(906, "same text"), (906, "same text"), (907, "long words and é " * 60_000)]
    frame = clashing(docs(rows))
    names = {"seed": "seed", "plain": "plain_percent", "spm": "spm_percent", "marks": "marks"}
    made = fill_in_middle(frame, **{names[k]: v for k, v in options.items()})
    assert made.columns == [*frame.columns, *COLUMNS[1:]]
    got = sorted((tuple(r[c] for c in COLUMNS) for r in made.collect()), key=str)
    assert got == sorted((by_hand(*row, **options) for row in rows), key=str)
    again = made.select("text", restored(F.col("output"), F.col("form"), options.get("marks", ("<P>", "<S>", "<M>"))).alias("t"))
    assert again.where(F.coalesce("text", F.lit("")) != F.col("t")).count() == 0


def test_all_forms_occur(docs):
    forms = {r["form"] for r in fill_in_middle(docs(texts(300))).collect()}
    assert forms == {"plain", "spm", "psm"}


def test_empty_table(docs):
    assert fill_in_middle(docs([])).collect() == []
