"""The pipeline against plain versions of its stages, each on its own input."""

from __future__ import annotations

import random

import pytest
import test_decontaminate as leaks
import test_line_dedup as lines
import test_simhash as prints
import test_toxicity as toxic
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyline.llm.bpe import default_path
from tallyline.llm.toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, docs, tmp_path_factory):
    """A folder of small tables with toxic documents, repeated lines, copies and benchmark passages."""
    rng = random.Random(3)
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, labels = toxic.corpus(500, 9)
    rows = [(i, t.replace(" wordb", "\nwordb", 1) + ("\n" + lines.LINES[i % 5] if i % 3 == 0 else "")) for i, t in rows]
    bench = leaks.items(rng, 8)
    rows += [(1000 + n, " ".join(leaks.prose(rng, 80) + text.split() + leaks.prose(rng, 80))) for n, (_, text) in enumerate(bench)]
    rows += [(2000 + n, rows[n][1]) for n in range(0, 60, 2)] + [(3000, None), (3001, ""), (3002, "short")]
    docs(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, toxic.LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, leaks.BENCH).write.parquet(f"{folder}/benchmark.parquet")
    return folder


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_stages_one_by_one(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    plain = {}

    def stage(name):
        nonlocal docs
        before = docs
        dict(corpus_pipeline.STAGES)[name](spark, docs, tables).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        return before, docs

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]
    before, after = stage("toxicity")
    rejected = score_toxicity(before, spark.read.parquet(f"{tables}/labels.parquet")).where(F.col("predicted") == 1)
    assert after.columns == COLUMNS and rejected.count() > 40
    assert sorted(pairs(after), key=str) == sorted(pairs(before.join(rejected, "doc_id", "left_anti")), key=str)
    clean = {r["doc_id"] for r in spark.read.parquet(f"{tables}/labels.parquet").where("toxic = 0").collect()}
    assert len(clean - {i for i, _ in pairs(after)}) <= 0.01 * len(clean)

    before, after = stage("line_dedup")
    assert sorted(pairs(after), key=str) == sorted(((i, t) for i, t, _, _ in lines.plain(pairs(before))), key=str)
    assert after.columns == COLUMNS and after.where("n_chars <> length(text)").count() == 0

    before, after = stage("near_dedup")
    rows = pairs(before)
    groups = prints.groups_of([prints.fingerprint(t) for _, t in rows], 3)
    for (doc, _), group in zip(rows, groups, strict=True):
        plain[group] = min(doc, plain.get(group, doc))
    assert {i for i, _ in pairs(after)} == set(plain.values()) and after.columns == COLUMNS
    assert after.count() == len(plain) < before.count()

    before, after = stage("decontamination")
    gone = {i for i, _ in pairs(before)} - {i for i, _ in pairs(after)}
    assert gone == {i for i, _ in pairs(before) if 1000 <= i < 2000} and len(gone) >= 6
    assert after.columns == COLUMNS

    before, after = stage("bpe")
    library = Tokenizer.from_file(default_path())
    wanted = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in pairs(before)}
    got = {r["doc_id"]: r for r in after.collect()}
    assert {i: r["ids"] for i, r in got.items()} == wanted
    assert all(r["n_tokens"] == len(r["ids"]) and r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) for r in got.values())


def test_run_is_the_stages_in_a_row(spark, tables):
    got = corpus_pipeline.run(spark, tables)
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert sorted(got.collect()) == sorted(docs.collect())


def test_stages_take_empty_documents(spark, docs, tables):
    empty = docs([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, tables).collect() == []


def test_stages_keep_extra_columns_and_rows_without_an_id(spark, docs, clashing, tables):
    """Null and repeated ids, null texts and columns of any name pass all stages that return documents."""
    rows = [(1, "a clean text of a few words"), (1, "a clean text of a few words"), (2, None), (2, ""), (None, "nobody's text"), (None, None)]
    frame = clashing(docs(rows))
    kept = {
        "toxicity": rows,
        "line_dedup": [(i, t or "") for i, t in rows],
        "near_dedup": [r for r in rows if r[0] != 99],
        "decontamination": rows,
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, frame, tables)
        assert found.columns == frame.columns, name
        got = sorted(((i, t or "") for i, t in pairs(found)), key=str)
        assert got == sorted(((i, t or "") for i, t in kept[name]), key=str), name
        assert found.select("row", "key", "drops").distinct().collect() == [("own row", "own key", "own drops")], name
