"""Language ID by a linear-chain conditional random field over words.

Every word of a text is labelled.  Its features are its affixes and inner
character n-grams of ``ORDERS`` letters (word edges count as a letter) and the
word itself (the lexicon), hashed into a table of weights; neighbouring labels
are tied by learned transitions, so that a switch of language inside a text is
followed but needs evidence.  Forward-backward gives each word's marginal
distribution, and a text's language is the label with the largest mean of them.

Forward-backward runs over chunks of ``CHUNK`` words of many texts at a time:
the transfer matrix of each chunk, then the messages between the chunks of a
text, then those inside all chunks.  This is the exact recursion, in fewer and
wider steps, whatever the lengths of the texts.

Scale: learning reads a bounded sample (``SAMPLE_ROWS`` rows of each language,
those with the smallest hashes of their ids) in one task, in mini-batches;
labelling is one pass over the documents without a shuffle.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
without any labelled row every text is; rows without an id or language are
labelled, never learned from; repeated rows are labelled alike; an input column
named like an output column is replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import blocks, first_by_hash, materialize, mix64, own_columns_win, training_row

BITS = 18
ORDERS = (2, 3)
CHUNK = 64
#: Rows of each language that a model learns from, at most (1,000: see ``first_by_hash``).
SAMPLE_ROWS = 1000
MINI_BATCH = 64
RATE, DECAY = 0.2, 1e-4
FOLDS = 5
UNDETERMINED = "und"

#: Code points below this are looked up; above it, all but the symbol blocks count as letters.
_TABLE = 0x3400
_LETTER = np.array([chr(c).isalpha() for c in range(_TABLE)])


def _is_letter(points: np.ndarray) -> np.ndarray:
    low = _LETTER[np.minimum(points, _TABLE - 1)]
    return np.where(points < _TABLE, low, (points < 0x1F000) | (points > 0x1FFFF))


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words, a 0 before, between and after them, and
    ``len(texts) + 1`` offsets of each text's words."""
    points = np.frombuffer("\0".join(["", *(x.lower() for x in texts), ""]).encode("utf-32-le"), dtype="<u4")
    edges = np.flatnonzero(points == 0)[1:]  # the end of each text (a NUL in a text separates words, see below)
    if len(edges) != len(texts):
        return words([x.replace("\0", " ") for x in texts])
    letter = _is_letter(points)
    letter[0] = False
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of each gap, its first place
    keep[0] = True
    flat = np.where(letter, points, 0)[keep].astype(np.uint64)
    started = letter & ~np.concatenate([[False], letter[:-1]])
    return flat, np.concatenate([[0], np.cumsum(started)[edges]]).astype(np.int64)


def features(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all features, and the word of each."""
    gap = flat == 0
    number = np.cumsum(np.concatenate([[0], (~gap[1:] & gap[:-1]).astype(np.int64)])) - 1  # the word at or before a place
    found, owners = [], []
    for order in ORDERS:
        n = max(0, len(flat) - order + 1)
        rolled = np.zeros(n, dtype=np.uint64)
        inside = np.ones(n, dtype=bool)
        for k in range(order):
            rolled += mix64(flat[k : k + n] + np.uint64((order << 8 | k) << 32))
            if 0 < k < order - 1:
                inside &= ~gap[k : k + n]
        found.append(mix64(rolled[inside]))
        owners.append(number[1 : n + 1][inside] if order > 1 else number[:n][inside])
    starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    if len(starts):
        place = np.arange(len(flat)) - starts[np.maximum(number, 0)]
        terms = mix64(flat ^ (place.astype(np.uint64) << np.uint64(32)))
        terms[gap] = 0
        found.append(mix64(np.add.reduceat(terms, starts)))
        owners.append(np.arange(len(starts)))
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


class Crf:
    """Weights (coordinates x labels) and transitions (labels x labels)."""

    def __init__(self, labels: list[str]):
        k = len(labels)
        self.labels = labels
        self.u, self.t = np.zeros((2**BITS, k), dtype=np.float32), np.zeros((k, k))

    def emissions(self, coordinates: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
        k = len(self.labels)
        e = np.empty((n, k))
        for j in range(k):
            e[:, j] = np.bincount(owners, weights=self.u[coordinates, j], minlength=n)
        return np.exp(e - e.max(axis=1, keepdims=True)) + 1e-30

    def messages(self, e: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward messages of all words, each scaled to sum 1.
        forward[i] holds the words up to i, backward[i] those after it."""
        k = len(self.labels)
        a = np.exp(self.t - self.t.max())
        lengths = np.diff(offsets)
        per_text = -(-lengths // CHUNK)
        first = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)
        chunks = int(first[-1])
        owner = np.repeat(np.arange(len(lengths)), per_text)
        at = offsets[:-1][owner] + (np.arange(chunks) - first[owner]) * CHUNK
        size = np.minimum(CHUNK, offsets[1:][owner] - at)
        # words as (chunk, place); places beyond a chunk's end pass messages on unchanged
        grid = np.ones((chunks, CHUNK, k))
        real = np.arange(CHUNK)[None, :] < size[:, None]
        grid[real] = e
        opens = np.zeros((chunks, CHUNK), dtype=bool)  # the first word of a text has no transition before it
        opens[first[:-1][per_text > 0], 0] = True

        def onward(m: np.ndarray, j: int) -> np.ndarray:
            step = np.where(opens[:, j, None, None], m, m @ a) * grid[:, j, None, :]
            step = np.where(real[:, j, None, None], step, m)
            return step / step.sum(axis=(1, 2), keepdims=True)

        transfer = np.broadcast_to(np.eye(k), (chunks, k, k))
        for j in range(CHUNK):
            transfer = onward(transfer, j)
        before = np.full((chunks, k), 1 / k)  # message into each chunk
        after = np.full((chunks, k), 1 / k)  # message from beyond each chunk, at its last word
        for step in range(1, int(per_text.max(initial=0))):
            here = (first[:-1] + step)[per_text > step]
            m = np.einsum("ci,cij->cj", before[here - 1], transfer[here - 1])
            before[here] = m / m.sum(axis=1, keepdims=True)
            back = (first[1:] - 1 - step)[per_text > step]
            m = np.einsum("cij,cj->ci", transfer[back + 1], after[back + 1])
            after[back] = m / m.sum(axis=1, keepdims=True)
        forward, backward = np.empty((chunks, CHUNK, k)), np.empty((chunks, CHUNK, k))
        m = before[:, None, :]
        for j in range(CHUNK):
            m = onward(m, j)
            forward[:, j] = m[:, 0]
        m = after
        for j in range(CHUNK - 1, -1, -1):
            backward[:, j] = m
            step = (grid[:, j] * m) @ a.T
            step /= step.sum(axis=1, keepdims=True)
            m = np.where(real[:, j, None], step, m)
        return forward[real], backward[real]

    def marginals(self, e: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        forward, backward = self.messages(e, offsets)
        both = forward * backward
        return both / both.sum(axis=1, keepdims=True)


class Learner:
    """Gradient ascent on the log-likelihood of the words' labels, with a rate
    for each coordinate (AdaGrad) and weights that decay."""

    def __init__(self, labels: list[str]):
        self.model = Crf(labels)
        self.squares_u, self.squares_t = np.full(self.model.u.shape, 1e-6, dtype=np.float32), np.full(self.model.t.shape, 1e-6)

    def learn(self, texts: list[str], golden: list[str]) -> None:
        model = self.model
        flat, offsets = words(texts)
        n = int(offsets[-1])
        if not n:
            return
        coordinates, owners = features(flat)
        e = model.emissions(coordinates, owners, n)
        forward, backward = model.messages(e, offsets)
        gamma = forward * backward
        gamma /= gamma.sum(axis=1, keepdims=True)
        lengths = np.diff(offsets)
        label = np.repeat([model.labels.index(x) for x in golden], lengths)
        weight = np.repeat(1 / np.maximum(lengths, 1), lengths)  # every text counts alike
        wrong = -gamma
        wrong[np.arange(n), label] += 1
        wrong *= weight[:, None]
        for j in range(len(model.labels)):
            g = np.bincount(coordinates, weights=wrong[owners, j], minlength=2**BITS)
            self.squares_u[:, j] += g * g
            model.u[:, j] += RATE * (g / np.sqrt(self.squares_u[:, j]) - DECAY * model.u[:, j])
        tied = np.ones(n, dtype=bool)  # words with one before them in the text
        tied[offsets[:-1][lengths > 0]] = False
        nxt = np.flatnonzero(tied)
        if len(nxt):
            pair = forward[nxt - 1][:, :, None] * np.exp(model.t - model.t.max()) * (e[nxt] * backward[nxt])[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            g = -(pair * weight[nxt, None, None]).sum(axis=0)
            np.add.at(g, (label[nxt - 1], label[nxt]), weight[nxt])
            self.squares_t += g * g
            model.t += RATE * (g / np.sqrt(self.squares_t) - DECAY * model.t)


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, folds: int = FOLDS) -> Crf:
    known = docs.filter("lang is not null and text is not null").filter(training_row(folds))
    keys = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    sample = materialize(first_by_hash(keys, sample_rows, "lang"), "language-sample")
    languages = sorted(r.lang for r in sample.select("lang").distinct().collect())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang")
    rows = texts.join(F.broadcast(sample), ["doc_id", "lang"])  # at most sample_rows ids a language
    # an id that repeats counts once, whatever its rows
    rows = rows.groupBy("__order", "lang").agg(F.min("text").alias("text"))
    rows = materialize(rows, "language-rows").coalesce(1).sortWithinPartitions("__order", "lang").select("text", "lang")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(languages)
        for batch in batches:
            for at in range(0, batch.num_rows, MINI_BATCH):
                part = batch.slice(at, MINI_BATCH)
                learner.learn(part.column(0).to_pylist(), part.column(1).to_pylist())
        model = learner.model
        used = np.flatnonzero(model.u.any(axis=1))
        held = pickle.dumps((used.astype(np.int32), model.u[used], model.t))
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary())], names=["model"])

    model = Crf(languages)
    if languages:
        for r in rows.mapInArrow(train, "model binary").collect():  # one row: at most 2 ** BITS x labels weights
            used, model.u[used], model.t = pickle.loads(r.model)
    return model


def judged(docs: DataFrame, model: Crf) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list[str], np.ndarray]]]:
    """For tasks: slices of batches with the language of each text and the mean
    marginal behind it."""
    used = np.flatnonzero(model.u.any(axis=1)).astype(np.int32)
    shared = docs.sparkSession.sparkContext.broadcast((model.labels, used, model.u[used], model.t))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str], np.ndarray]]:
        labels, rows, weights, transitions = shared.value
        crf = Crf(labels)
        crf.u[rows], crf.t = weights, transitions
        for batch, raw in blocks(batches):
            texts = [x.decode() for x in raw]
            n = len(texts)
            found, score = np.full(n, -1), np.zeros(n)
            flat, offsets = words(texts)
            lengths = np.diff(offsets)
            if labels and offsets[-1]:
                gamma = crf.marginals(crf.emissions(*features(flat), int(offsets[-1])), offsets)
                share = np.zeros((n, len(labels)))
                np.add.at(share, np.repeat(np.arange(n), lengths), gamma)
                share /= np.maximum(lengths, 1)[:, None]
                found = np.where(lengths > 0, share.argmax(axis=1), -1)
                score = np.where(lengths > 0, share.max(axis=1).clip(0, 1), 0.0)
            names = [labels[i] if i >= 0 and any(map(str.isalpha, t)) else UNDETERMINED for i, t in zip(found, texts, strict=True)]
            yield batch, names, np.where([x == UNDETERMINED for x in names], 0.0, score)

    return judge


def label(docs: DataFrame, model: Crf, columns: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language of each text and the mean marginal behind it."""
    docs = own_columns_win(docs, columns)
    judge = judged(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, names, score in judge(batches):
            yield batch.append_column(columns[0], pa.array(names, pa.string())).append_column(columns[1], pa.array(score))

    schema = T.StructType([*docs.schema.fields, T.StructField(columns[0], T.StringType()), T.StructField(columns[1], T.DoubleType())])
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row of (doc_id, text, lang)."""
    labelled = label(docs.select("doc_id", F.col("text").cast("string").alias("text")), learn(docs))
    return labelled.select("doc_id", (~training_row(FOLDS)).alias("held_out"), "lang_pred", "score")


def drop_undetermined(docs: DataFrame, least: float = 1 / 3) -> DataFrame:
    """The rows of ``docs`` with a language that holds a third of the words at
    least: texts that switch between two languages stay."""
    judge = judged(docs, learn(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, names, score in judge(batches):
            yield batch.filter(pa.array((score >= least) & np.array([x != UNDETERMINED for x in names], dtype=bool)))

    return docs.mapInArrow(run, docs.schema)
