from __future__ import annotations

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyline.llm.toxicity import Settings, _Hashes, features, learning_rows, score_toxicity, without_toxic, word_hashes

LABELS = "doc_id long, toxic int"
hashes = _Hashes()
GOOD = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
BAD = ["vile", "rotten", "foul", "nasty"]


def corpus(n, seed=0):
    random.seed(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = random.random() < 0.15
        words = [random.choice(GOOD) for _ in range(random.randrange(20, 120))]
        if toxic:
            for _ in range(random.randrange(1, 4)):
                words.insert(random.randrange(len(words)), random.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(spark, docs):
    rows, labels = corpus(2500)
    got = {r["doc_id"]: r for r in score_toxicity(docs(rows), spark.createDataFrame(labels, LABELS)).collect()}
    assert len(got) == len(rows)
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for i, r in got.items())
    truth = [(got[i]["predicted"], y) for i, y in labels if held(i)]
    wrong = sum(p and not y for p, y in truth)
    caught = sum(p and y for p, y in truth) / sum(y for _, y in truth)
    assert wrong <= 0.01 * len(truth) and caught > 0.85


def test_held_out_labels_are_not_learnt(spark, docs):
    rows, labels = corpus(600, 1)
    turned = [(i, 1 - y if held(i) else y) for i, y in labels]
    scores = [score_toxicity(docs(rows), spark.createDataFrame(x, LABELS)).select("doc_id", "score").collect() for x in (labels, turned)]
    assert sorted(scores[0]) == sorted(scores[1])


def test_same_weights_however_the_rows_lie(spark, docs):
    rows, labels = corpus(400, 2)
    known = spark.createDataFrame(labels, LABELS)
    one = sorted(score_toxicity(docs(rows), known).select("doc_id", "score").collect())
    two = sorted(score_toxicity(docs(rows[::-1]).repartition(9), known.repartition(5)).select("doc_id", "score").collect())
    assert one == two


def test_nulls_empty_long_repeated_clashing(spark, docs, clashing):
    rows, labels = corpus(300, 3)
    odd = [(1000, None), (1001, ""), (1002, "..."), (1003, "wordaa " * 200_000 + "vile"), (1004, rows[0][1]), (None, "vile foul"), (1005, "a")]
    known = [*labels, (5, None), (None, 1), (7, 1), (7, 0), (7, 1), (99_999, 1), (1000, 0)]
    frame = clashing(docs([*rows, *odd, rows[0]]))
    result = score_toxicity(frame, spark.createDataFrame(known, LABELS))
    got = result.collect()
    assert len(got) == len(rows) + len(odd) + 1
    assert result.columns == [*[c for c in frame.columns], *[c for c in ("held_out", "predicted") if c not in frame.columns]]
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1000]["score"] == by_id[1001]["score"] == by_id[1002]["score"]
    assert by_id[1004]["score"] == by_id[0]["score"] and by_id[None]["held_out"] is False
    kept = without_toxic(frame, spark.createDataFrame(known, LABELS))
    assert kept.columns == frame.columns and kept.first()["score"] == "own score"
    assert kept.count() == sum(r["predicted"] == 0 for r in got)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], LABELS)
    assert score_toxicity(docs([]), none).collect() == []
    assert [r["score"] for r in score_toxicity(docs([(1, "a b")]), none).collect()] == [0.5]


def test_the_sample_is_bounded(spark, docs):
    rows, labels = corpus(900, 4)
    small = learning_rows(docs(rows), spark.createDataFrame(labels, LABELS), Settings(sample_rows=100))
    assert 50 < small.count() < 160
    assert not any(held(i) for i in [r["known"] for r in small.join(docs(rows), "text").select(F.col("doc_id").alias("known")).collect()])


def test_features_hold_words_pairs_triples_and_skips():
    words = np.array([11, 22, 33, 44], np.uint64)
    assert len(features(words, 40)) == 4 + 3 + 2 + 2
    assert len(features(np.zeros(0, np.uint64), 40)) == 0 and len(features(words[:1], 40)) == 1
    assert set(features(words[:2], 40)) <= set(features(words, 40))


def test_scores_equal_a_plain_ftrl(spark, docs):
    """FTRL-proximal written out, one coordinate after another, over the same rows in the same order."""
    rows, labels = corpus(300, 5)
    rows += [(1000, None), (1001, "")]
    settings = Settings(bits=14, passes=2)
    known = spark.createDataFrame(labels, LABELS)
    sample = learning_rows(docs(rows), known, settings).collect()
    order = sorted(sample, key=lambda r: (r["place"], r["label"], word_hashes(r["text"], hashes).tobytes()))
    z, n = {}, {}

    def weight(i):
        l1 = 0.0 if i < 0 else settings.l1
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        step = (settings.beta + math.sqrt(n.get(i, 0.0))) / settings.alpha + settings.l2
        return -math.copysign(abs(z[i]) - l1, z[i]) / step

    def coordinates(text):
        return [*features(word_hashes(text or "", hashes), settings.bits).tolist(), -1]

    for _ in range(settings.passes):
        for row in order:
            at = coordinates(row["text"])
            weights = {i: weight(i) for i in at}
            gradient = 1 / (1 + math.exp(-sum(weights.values()))) - row["label"]
            for i, w in weights.items():
                before = n.get(i, 0.0)
                n[i] = before + gradient**2
                z[i] = z.get(i, 0.0) + gradient - (math.sqrt(n[i]) - math.sqrt(before)) / settings.alpha * w
    got = {r["doc_id"]: r["score"] for r in score_toxicity(docs(rows), known, settings).collect()}
    for doc, text in rows:
        wanted = 1 / (1 + math.exp(-sum(map(weight, coordinates(text)))))
        assert abs(got[doc] - wanted) < 1e-9


def test_features_are_words_pairs_triples_and_skips():
    """As many as the distinct n-grams and skip-grams of a text, and the same for the same ones in another order."""
    assert len(features(word_hashes("a b c d", hashes), 40)) == 4 + 3 + 2 + 2
    assert len(features(word_hashes("a a a a", hashes), 40)) == 4
    assert len(features(word_hashes("A b!", hashes), 40)) == 3 and len(features(word_hashes("", hashes), 40)) == 0
