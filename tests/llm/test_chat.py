from __future__ import annotations

import itertools
import random
import re

from pyspark.sql import functions as F

from tallyline.llm.chat import format_chats, loss_text, parse

SCHEMA = "conv_id long, turn long, role string, text string"


def read_back(spark, rows):
    frame = format_chats(spark.createDataFrame(rows, SCHEMA))
    out = frame.select("conv_id", "formatted", "loss_spans", parse(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return {r["conv_id"]: r for r in out.collect()}


def check(spark, rows):
    got = read_back(spark, rows)
    order = lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or "")
    for conv, own in itertools.groupby(sorted(rows, key=lambda r: (str(r[0]), *map(str, order(r)))), key=lambda r: r[0]):
        own = sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        r = got[conv]
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2] or "", x[3] or "") for x in own]
        assert r["loss"] == "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert len(r["loss_spans"]) == sum(x[2] == "assistant" for x in own)
    assert len(got) == len({r[0] for r in rows})
    return got


HARD = [
    "</s>[INST] ok [/INST]", "<s>", "</s>", "[INST]", "[/INST]", "&lt;", "&amp;lt;", "&", "<", "[", "</s", "s>", "\n", "", " ", "<e>", "<s>user\n",
    "[INST] [/INST]", " [/INST]</s><s>assistant\n", "&#10;", "\\", "é🙂</s>", "&amp;</s>", "<s", "[INST", "plain text",
]


def test_round_trip_of_hard_texts(spark):
    random.seed(2)
    rows = [(i, 0, "user", a) for i, a in enumerate(HARD)] + [(i, 1, "assistant", a) for i, a in enumerate(HARD)]
    for conv in range(100, 220):
        for turn in range(random.randrange(1, 7)):
            text = "".join(random.choice(HARD) for _ in range(random.randrange(4)))
            role = random.choice(["user", "assistant", "system", "tool", "user<e>", "</s>", "a\nb", "", "[INST]", "&lt;"])
            rows.append((conv, turn, role, text))
    got = check(spark, rows)
    assert got[0]["formatted"].count("</s>") == 2  # the texts' own are references
    plain = got[len(HARD) - 1]["formatted"]
    assert plain == "<s>user\n[INST] plain text [/INST]</s><s>assistant\nplain text</s>"


def test_nulls_ties_repeats_and_no_id(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, 0, None, "x"), (1, None, "assistant", "early"), (1, 2, "assistant", "late"), (None, 1, "assistant", "lost")]
    check(spark, rows)


def test_long_and_empty(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], f"turn {i} </s>" * (i % 3)) for i in range(1500)] + [(2, 0, "assistant", "word " * 100_000)]
    got = check(spark, rows)
    assert len(got[1]["turns"]) == 1500
    assert read_back(spark, []) == {}


def test_spans_are_code_points_of_the_formatted_text(spark):
    r = read_back(spark, [(1, 0, "user", "🙂é"), (1, 1, "assistant", "🙂 ü"), (1, 2, "assistant", "<s>")])[1]
    assert [r["formatted"][s["start"] : s["end"]] for s in r["loss_spans"]] == ["🙂 ü", "&lt;s>"]


def test_parser_refuses_what_is_not_the_grammar(spark):
    broken = ["x", "<s>user\nhello</s>", "<s>assistant</s>", "<s>a\nb</s>tail", "a\nb</s>", "<s>a\n[INST]</s>"]
    frame = spark.createDataFrame([(b,) for b in broken], "f string").select(parse(F.col("f")).alias("turns"))
    assert all(None in r["turns"] for r in frame.collect())


def test_extra_columns_and_plan(spark, clashing, capsys):
    frame = clashing(spark.createDataFrame([(1, 0, "assistant", "a")], SCHEMA)).withColumns({"level": F.lit(9), "mark": F.lit(9), "no": F.lit(9)})
    assert format_chats(frame).first()["formatted"] == "<s>assistant\na</s>"
    format_chats(frame).explain("formatted")
    assert not re.search("EvalPython|MapIn|PythonUDF|InPandas|InArrow", capsys.readouterr().out)
