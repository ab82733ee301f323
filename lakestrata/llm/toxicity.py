"""Toxicity by FTRL-proximal logistic regression over hashed words.

Features are the distinct word uni-grams, bi-grams and skip-grams (one or two
words left out) of the whole text, hashed into ``2 ** BITS`` coordinates.  The
online learner keeps a learning rate for each coordinate, and its L1 term
leaves the weights of rare or uninformative coordinates at exactly zero, so that
the model is a short list of numbers that goes to every task.

Scale: learning reads a bounded sample of labelled rows (``SAMPLE_ROWS``, those
with the smallest hashes of their ids) in one task, row by row; everything else
is one pass over the documents without a shuffle.

Defined cases: a null or empty text has the score of the bias alone; without
any labelled row the score is 1/3; a document with several labels takes the
highest; null labels and labels of unknown documents are left out; rows without
an id are scored, never learned from; repeated rows are scored alike; an input
column named like an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import blocks, first_by_hash, materialize, mix64, own_columns_win, training_row, word_hashes

BITS = 20
#: Labelled rows that a model learns from, at most.
SAMPLE_ROWS = 20_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.1
START_BIAS = float(np.log(1 / 2))
FOLDS = 5

#: ASCII bytes other than letters and digits separate words.
_GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all features of the texts, and the text of each."""
    words, offsets = word_hashes(texts, _GAPS)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    found, owners = [words], [owner]
    for gap in (1, 2, 3):  # neighbours; one word left out; two words left out
        same = owner[gap:] == owner[:-gap]
        found.append(mix64(words[:-gap] * np.uint64(2 * gap + 1) ^ mix64(words[gap:]))[same])
        owners.append(owner[gap:][same])
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int32), np.concatenate(owners)


def distinct(coordinates: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(owners.astype(np.int64) << BITS | coordinates)
    return (pairs & (2**BITS - 1)).astype(np.int32), pairs >> BITS


class Ftrl:
    """The learner's state; the bias is a coordinate without penalties."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.bias, self.bias_n = START_BIAS, 0.0

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        slope = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / slope)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(self.bias + w.sum(), -30, 30))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g
        self.bias_n += g * g
        self.bias -= ALPHA * g / (BETA + np.sqrt(self.bias_n))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, folds: int = FOLDS) -> list[tuple[int, float]]:
    """(coordinate, weight) of all weights that are not zero; the bias is at -1."""
    marked = labels.filter("toxic is not null and doc_id is not null").filter(training_row(folds))
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    sample = materialize(first_by_hash(marked, sample_rows), "toxic-sample")  # at most sample_rows narrow rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in blocks(batches):
            coordinates, owners = distinct(*features(raw))
            cuts = np.searchsorted(owners, np.arange(len(raw) + 1))
            held = [coordinates[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("__order"), batch.column("toxic").cast(pa.int32()), pa.array(held, pa.binary())], names=["place", "label", "found"])

    rows = texts.select("text", "toxic", "__order").mapInArrow(featurize, "place long, label int, found binary")
    # an id that repeats counts once, whatever its rows
    rows = materialize(rows.groupBy("place").agg(F.min(F.struct("label", "found")).alias("r")).select("place", "r.*"), "toxic-features")
    rows = rows.coalesce(1).sortWithinPartitions("place").select("label", "found")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one pass over the stream learns; a second goes over its kept coordinates
        model, kept = Ftrl(2**BITS), []
        for batch in batches:
            for label, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                kept.append((np.frombuffer(found, dtype=np.int32), int(label == 1)))
                model.learn(*kept[-1])
        for _ in range(EPOCHS - 1):
            for at, label in kept:
                model.learn(at, label)
        w = model.weights(slice(None))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1], at]), pa.int32()), pa.array(np.concatenate([[model.bias], w[at]]), pa.float64())], names=["coordinate", "weight"]
        )

    return [(r.coordinate, r.weight) for r in rows.mapInArrow(train, "coordinate int, weight double").collect()]


def judged(docs: DataFrame, weights: list[tuple[int, float]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, np.ndarray]]]:
    """For tasks: slices of batches with the probability that each text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # sparse: at most 2 ** BITS pairs

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        dense = np.zeros(2**BITS)
        bias = dict(shared.value).get(-1, START_BIAS)
        for at, w in shared.value:
            if at >= 0:
                dense[at] = w
        for batch, raw in blocks(batches):
            coordinates, owners = features(raw)
            heavy = dense[coordinates] != 0
            coordinates, owners = distinct(coordinates[heavy], owners[heavy])
            total = bias + np.bincount(owners, weights=dense[coordinates], minlength=len(raw))
            yield batch, 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    return judge


def score(docs: DataFrame, weights: list[tuple[int, float]], column: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is toxic."""
    docs = own_columns_win(docs, [column])
    judge = judged(docs, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, p in judge(batches):
            yield batch.append_column(column, pa.array(p))

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of (doc_id, text)."""
    weights = learn(docs, labels)
    scored = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), weights)
    return scored.select("doc_id", (~training_row(FOLDS)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    judge = judged(docs, learn(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, p in judge(batches):
            yield batch.filter(pa.array(p < 0.5))

    return docs.mapInArrow(run, docs.schema)
