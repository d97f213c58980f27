"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct words, pairs of neighbouring words, triples, and pairs with one word between them,
hashed to ``2 ** bits`` coordinates.  FTRL-proximal keeps a learning rate for each coordinate and leaves those without
evidence at exactly zero, so the trained weights are a short list that can be broadcast; scoring is one map.

Learning is one pass after another over a bounded sample of labelled rows, in a fixed order, so it gives the same
weights on every run.  The bound is ``Settings.sample_rows``; scoring covers every row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from tallyline.llm.common import batches, give_back, packed, small_batches, text_of, unpacked

_WORD = re.compile(r"[^\W\d_]+")
_HELD_WORDS = 1 << 18
_LEARN = pa.schema([("place", pa.int64()), ("label", pa.int32()), ("words", pa.binary())])
_SHARES = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Parameters of the model.  ``sample_rows`` bounds the labelled rows it learns from (all, if there are fewer)."""

    bits: int = 20
    sample_rows: int = 20_000
    passes: int = 4
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.0
    threshold: float = 0.7


class _Hashes(dict):
    """Word hashes, kept for words seen lately."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _HELD_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_hashes(text: str, known: dict[str, int]) -> np.ndarray:
    words = _WORD.findall(text.lower())
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def features(words: np.ndarray, bits: int) -> np.ndarray:
    """The distinct coordinates of a text's n-grams and skip-grams."""
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    pairs = words[:-1] * a + words[1:] * b + np.uint64(1)
    triples = pairs[:-1] * a + words[2:] * b + np.uint64(2)
    skips = words[:-2] * a + words[2:] * b + np.uint64(3)
    mixed = np.concatenate([words, pairs, triples, skips]) * a
    mixed ^= mixed >> np.uint64(32)
    return np.unique((mixed * b) >> np.uint64(64 - bits)).astype(np.int64)


def _hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Hashes()

    def rows() -> Iterator[tuple]:
        for part in parts:
            for place, label, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                yield place, label, word_hashes(text, known).tobytes()

    yield from batches(rows(), _LEARN)
    known.clear()
    give_back()


def _learned(parts: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """The non-zero weights; coordinate -1 is the constant."""
    rows = [(label, words) for part in parts for _, label, words in zip(*(c.to_pylist() for c in part.columns), strict=True)]
    size = 1 << settings.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        pull = np.maximum(np.abs(z[at]) - np.where(at == size, 0.0, settings.l1), 0.0)
        return -np.sign(z[at]) * pull / ((settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2)

    for _ in range(settings.passes):
        for label, words in rows:
            at = np.append(features(np.frombuffer(words, np.uint64), settings.bits), size)
            w = weights(at)
            g = sigmoid(w.sum()) - label
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / settings.alpha * w
            n[at] = grown
    final = weights(np.arange(size + 1))
    used = np.flatnonzero(final)
    yield pa.record_batch([pa.array(np.where(used == size, -1, used)), pa.array(final[used])], names=["at", "weight"])
    rows.clear()
    give_back()


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def learn(labelled: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) from rows (place, label, text), learnt in the order of ``place``."""
    words = labelled.select("place", "label", "text").mapInArrow(_hashed, "place long, label int, words binary")
    one = words.repartition(1).sortWithinPartitions("place", "label", "words")
    found = one.mapInArrow(partial(_learned, settings=settings), "at long, weight double").collect()
    return np.array([r["at"] for r in found], np.int64), np.array([r["weight"] for r in found], float)


def _scored(parts: Iterator[pa.RecordBatch], model: Broadcast, bits: int) -> Iterator[pa.RecordBatch]:
    at, weight = model.value
    dense, known = np.zeros(1 << bits), _Hashes()
    dense[at[at >= 0]] = weight[at >= 0]
    constant = float(weight[at < 0].sum())
    for part in parts:
        texts = part.column("text").to_pylist()
        scores = [sigmoid(constant + dense[features(word_hashes(t, known), bits)].sum()) for t in texts]
        yield pa.record_batch([part.column("row"), pa.array(scores, pa.float64())], names=["row", "score"])
    known.clear()
    give_back()


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels are kept from learning: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learning_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(place, label, text): at most about ``sample_rows`` labelled documents outside the held-out third, by hash."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("known"))
        .agg(F.max(F.col("toxic").cast("int")).alias("label"))
        .withColumn("place", F.xxhash64("known"))
    )
    share = int(_SHARES * min(1.0, settings.sample_rows / max(1, known.count())))
    sample = known.where(F.pmod("place", F.lit(_SHARES)) < share)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_of(docs).alias("text"))
    # the sample's size is bounded by sample_rows, so its ids may be broadcast; no text is shuffled for the join
    return texts.join(F.broadcast(sample), F.col("id") == F.col("known")).select("place", "label", "text")


def _with_scores(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(row, score) of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(learn(learning_rows(docs, labels, settings), settings))
    rows = packed(docs, text=text_of(docs))
    shape = StructType([rows.schema["row"]]).add("score", DoubleType())
    return rows.mapInArrow(partial(_scored, model=model, bits=settings.bits), shape)


def score_toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` with ``held_out``, ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` (0 or 1).

    Only text is read for a score.  Null and empty texts get the constant's score.  Labels: several rows for one
    document count as toxic if one does; null labels and ids are left out; without labels every score is one half.
    Repeated rows get equal scores.  Columns of the three names are replaced, all others kept.
    """
    return unpacked(
        _with_scores(docs, labels, settings),
        docs.columns,
        held_out=held_out(F.col("row")["doc_id"]),
        score=F.col("score"),
        predicted=(F.col("score") >= settings.threshold).cast("int"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score stays below the threshold.

    Null and empty texts are judged by the constant's score alone; rows without an id and repeated rows are judged by
    their texts like all others.
    """
    return unpacked(_with_scores(docs, labels, settings).where(F.col("score") < settings.threshold), docs.columns)
