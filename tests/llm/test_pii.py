from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyline.llm.pii import digest, luhn, mod97, personal_data


def base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        total = sum(x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(digits[::-1]))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


def spans(docs, rows):
    got = {}
    for r in personal_data(docs(rows)).collect():
        got[r["doc_id"]] = [(s["start"], s["kind_no"], s["end"], s["kind"]) for s in r["spans"]]
    return got


CASES = [
    None,
    "",
    "a@b.c@d.e x.y+z%1@host-1.example.com. é@x.y ü.ü@a.b",
    "a@b.cd.e_f@g.hi _@a.b-.c @a.b a@b a@.b",
    "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.1 01.02.03.04 1.2.3 999.9.9.9.9 1.2.3.2555",
    "4111 1111 1111 1111, 4111-1111-1111-1112; 4111  1111 1111 1111 and 0000000000000 12345678901234567890",
    "+1 (415) 555-0100 ext +49 30 123456-78) +1-2 +12345678 +123456789 ++44 20 7946 0958 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "🙂 mail: ä🙂b@c.de 🙂 10.0.0.1🙂",
    "9" * 3000 + " " + "1-" * 3000 + "5 " + "a." * 5000 + " " + "7." * 3000,
]


def test_base_spans(docs):
    random.seed(1)
    pieces = [*"0123456789", "@", ".", "-", "+", " ", "a", "b.c", "é", "(", ")", "4111111111111111", "+1 415 555 0100", "x@y.z", "1.2.3.4"]
    texts = CASES + ["".join(random.choice(pieces) for _ in range(random.randrange(60))) for _ in range(400)]
    got = spans(docs, list(enumerate(texts)))
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[1] < 4] == base(text or ""), text


def test_added_spans(docs):
    texts = [
        "konto DE89 3704 0044 0532 0130 00 heute",
        "no DE89370400440532013001 no",
        "call (415) 555-0100 now",
        "the number 415 555-0100 alone",
        "ssn 078-05-1120, and 078-05-1120" + " far" * 20,
        'token = "f3ef4d6b2755a36d7d9c25bd72ab01cd"',
        "f3ef4d6b2755a36d7d9c25bd72ab01cd",
        "tel +1 (415) 555-0100",
    ]
    got = spans(docs, list(enumerate(texts)))
    assert [[s[3] for s in got[i]] for i in range(len(texts))] == [
        ["iban"], [], ["local_phone"], [], ["id_number"], ["secret"], [], ["phone"],
    ]
    assert got[0] == [(6, 4, 33, "iban")]


def test_context_moves_the_score(docs):
    rows = [(1, "visa 4111111111111111"), (2, "it is 4111111111111111")]
    score = {r["doc_id"]: r["spans"][0]["score"] for r in personal_data(docs(rows)).collect()}
    assert score[1] > score[2]


@pytest.mark.parametrize(("digits", "right"), [("79927398713", True), ("79927398710", False), ("0", True), ("18", True)])
def test_luhn(spark, digits, right):
    assert spark.range(1).select(luhn(F.lit(digits))).first()[0] is right


@pytest.mark.parametrize(("code", "right"), [("GB82WEST12345698765432", True), ("GB82WEST12345698765433", False), ("FR1420041010050500013M02606", True)])
def test_mod97(spark, code, right):
    assert spark.range(1).select(mod97(F.lit(code))).first()[0] is right


def test_empty_repeated_and_clashing(docs, clashing):
    assert personal_data(docs([])).collect() == []
    frame = clashing(docs([(1, "x@y.zz 1.2.3.4"), (1, "x@y.zz 1.2.3.4"), (None, "x@y.zz")])).withColumns({"m0": F.lit(1), "g0": F.lit(2), "s0": F.lit(3)})
    result = personal_data(frame)
    assert result.columns == [*frame.columns, "spans"]
    rows = result.select("doc_id", "m0", "row", digest(F.col("spans")).alias("d")).collect()
    assert sorted(map(str, rows)) == sorted(
        map(str, [r.__class__(doc_id=i, m0=1, row="own row", d=d) for r in rows[:1] for i, d in [(1, "email:0:6,ip:7:14"), (1, "email:0:6,ip:7:14"), (None, "email:0:6")]])
    )
    # a column named as the result is replaced, in its place
    assert personal_data(frame.withColumn("spans", F.lit(0))).columns.count("spans") == 1


def test_no_python_in_the_plan(docs, capsys):
    personal_data(docs([(1, "a")])).explain("formatted")
    assert not re.search("EvalPython|MapIn|PythonUDF|InPandas|InArrow", capsys.readouterr().out)
