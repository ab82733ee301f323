"""Language-model scores by subword lattice likelihood.

A text is a sequence of lower-cased words and one end.  A word, with the
vocabulary's word-start sign before it, is a lattice of all its segmentations
into pieces of an existing vocabulary.  Its probability is the sum over all of
them, by forward recursion in log space, whether the word was seen in training
or not.  Paths never cross words, so that a text's marginal probability is the
product over its words and its end.

The vocabulary is a public tokenizer's and is never changed.  Its own scores
are ranks; they start the pieces' probabilities (by Zipf's law), and expectation
maximisation over the counts of all training words (forward-backward, soft
counts of all segmentations) fits them to the corpus.  A character that is no
piece costs one learned pseudo-piece and its bytes at 1/256 each.

Scale: texts are split twice.  The first pass counts words; the table of
distinct words carries counts and lattice probabilities from there on, so that
each word's lattice is run once, whatever its frequency.  In the second pass
the words above 1 / ``HEAVY`` of all tokens (at most ``HEAVY``, so their table is
bounded) are summed in place; only the rest meets the word table in a join,
where no key can be hot.

Defined cases: a null or empty text is its end alone; rows without an id are
held out; repeated rows are scored each, and count each in training; without
training rows the counts are 0 and all tokens have the same base probability;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import materialize, mix64, training_row

FOLDS = 10
HEAVY = 200_000
HEAVY_BYTES = 64  # longer words are never among the heavy ones, which bounds their table
EM_ROUNDS = 2
PSEUDO_COUNT = 0.1
PIECE_PSEUDO_COUNT = 0.01
END = ""  # words are never empty
START_SIGN = "▁"
FLUSH_WORDS = 200_000
CELLS = 1 << 16
TOGETHER = 60_000  # words whose lattices are run together, and
TOGETHER_BYTES = 4 << 20  # their bytes


def vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """(piece, score) of the pieces that a word can hold; score: higher is
    more likely.  The end sign comes first."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [(END, max(s for _, s in pieces)), *((p, s) for p, s in pieces if START_SIGN not in p[1:] and not any(c.isspace() for c in p))]


def starting_probabilities(pieces: list[tuple[str, float]]) -> np.ndarray:
    """Zipf's law over the ranks of the vocabulary's scores; one more entry for
    characters that are no piece."""
    rank = np.argsort(np.argsort([-s for _, s in pieces], kind="stable"), kind="stable")
    p = np.append(1 / (rank + 100.0), 1e-6)
    return np.log(p / p.sum())


class Lattice:
    """Segmentations of words into pieces; ``logp`` has natural logarithms."""

    SLOT_BITS = 20
    PROBES = 8
    _BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[str], logp: np.ndarray):
        self.logp = np.append(logp, -np.inf)  # the last: no piece
        self.unknown, self.none = len(pieces), len(pieces) + 1
        self.longest = max(map(len, pieces))
        self.keys = np.zeros(self.none + 1, dtype=np.uint64)
        self.slots = np.full((1 << self.SLOT_BITS) + self.PROBES, self.none, dtype=np.int32)
        for i, piece in enumerate(pieces):
            if piece:
                h = np.zeros(1, dtype=np.uint64)
                for c in piece:
                    h = h * self._BASE + np.uint64(ord(c) + 1)
                self.keys[i] = mix64(h)[0]
                at = int(self.keys[i]) >> (64 - self.SLOT_BITS)
                free = np.flatnonzero(self.slots[at : at + self.PROBES] == self.none)
                self.slots[at + free[0]] = i

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Piece of each key.  Most places are no piece, which an empty slot
        tells at once; only those that meet another piece look further."""
        sought = keys.ravel()
        at = (sought >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)
        found = self.slots[at]
        left = np.flatnonzero(found != self.none)
        left = left[self.keys[found[left]] != sought[left]]
        found[left] = self.none
        for probe in range(1, self.PROBES):
            if not len(left):
                break
            got = self.slots[at[left] + probe]
            taken = got != self.none
            left, got = left[taken], got[taken]
            hit = self.keys[got] == sought[left]
            found[left[hit]] = got[hit]
            left = left[~hit]
        return found.reshape(keys.shape)

    def edges(self, points: np.ndarray, lengths: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Piece and log score of the pieces of each length at each place of
        the words (rows of code points; those beyond a word's length are none,
        while a code point 0 within it is a character)."""
        width = points.shape[1]
        inside = np.arange(width)[None, :] < lengths[:, None]
        pieces, scores = [], []
        rolled = np.zeros(points.shape, dtype=np.uint64)
        chars = points.astype(np.uint64) + np.uint64(1)
        for n in range(1, min(self.longest, width) + 1):
            rolled = rolled[:, : width - n + 1] * self._BASE + chars[:, n - 1 :]
            found = self._find(mix64(rolled))
            score = self.logp[found]
            if n == 1:
                bare = (found == self.none) & inside
                found[bare] = self.unknown
                size = 1 + (points >= 0x80).astype(int) + (points >= 0x800) + (points >= 0x10000)
                score = np.where(bare, self.logp[self.unknown] - size * math.log(256), score)
            pieces.append(found)
            scores.append(score)
        return pieces, scores

    def forward(self, scores: list[np.ndarray]) -> np.ndarray:
        rows, width = scores[0].shape
        a = np.full((width + 1, rows), -np.inf)
        a[0] = 0
        steps = [np.ascontiguousarray(x.T) for x in scores]
        for j in range(1, width + 1):
            for n in range(1, min(j, len(steps)) + 1):
                step = steps[n - 1][j - n]
                live = np.flatnonzero(step > -np.inf)
                if len(live):
                    a[j, live] = np.logaddexp(a[j, live], a[j - n, live] + step[live])
        return a.T

    def backward(self, scores: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
        rows, width = scores[0].shape
        b = np.full((width + 1, rows), -np.inf)
        b[lengths, np.arange(rows)] = 0
        steps = [np.ascontiguousarray(x.T) for x in scores]
        for i in range(width - 1, -1, -1):
            for n in range(1, min(width - i, len(steps)) + 1):
                step = steps[n - 1][i]
                live = np.flatnonzero(step > -np.inf)
                if len(live):
                    b[i, live] = np.logaddexp(b[i, live], step[live] + b[i + n, live])
        return b.T

    @staticmethod
    def batches(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(which words, code points, lengths), words of like lengths together."""
        lengths = np.array([len(w) + 1 for w in words])
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            # the longest word of a batch sets its width; batches have about CELLS cells
            end = at + max(1, CELLS // int(lengths[order[at]]))
            while end > at + 1 and (min(end, len(order)) - at) * int(lengths[order[min(end, len(order)) - 1]]) > 2 * CELLS:
                end = at + max(1, (min(end, len(order)) - at) // 2)
            which = order[at:end]
            n = lengths[which]
            points = np.zeros((len(which), int(n.max())), dtype=np.uint32)
            text = "".join(START_SIGN + words[i] for i in which)
            points[np.arange(points.shape[1])[None, :] < n[:, None]] = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
            yield which, points, n
            at = end

    def word_logps(self, words: list[str]) -> np.ndarray:
        """Log probability of each word, over all its segmentations."""
        out = np.full(len(words), self.logp[0])  # the end sign
        full = [i for i, w in enumerate(words) if w != END]
        for which, points, n in self.batches([words[i] for i in full]):
            out[np.array(full)[which]] = self.forward(self.edges(points, n)[1])[np.arange(len(which)), n]
        return out

    def soft_counts(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece, and of unknown characters."""
        total = np.zeros(self.none)
        ends = np.array([w == END for w in words], dtype=bool)
        full = np.flatnonzero(~ends)
        total[0] = counts[ends].sum()
        for which, points, n in self.batches([words[i] for i in full]):
            pieces, scores = self.edges(points, n)
            a, b = self.forward(scores), self.backward(scores, n)
            whole = a[np.arange(len(which)), n]
            weight = counts[full[which]]
            for k, (found, score) in enumerate(zip(pieces, scores, strict=True), 1):
                row, at = np.nonzero(score > -np.inf)
                live = score[row, at]
                used = np.exp(a[row, at] + live + b[row, at + k] - whole[row]) * weight[row]
                total += np.bincount(found[row, at], weights=used, minlength=self.none + 1)[: self.none]
        return total


def split_words(text: bytes) -> list[bytes]:
    """Lower-cases A-Z and splits at the white space of ASCII."""
    return text.lower().split()


def count_words(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(word, c, n): counts in training rows and in all; the end is the empty word."""
    schema = pa.schema([("word", pa.string()), ("c", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {True: Counter(), False: Counter()}

        def flush() -> pa.RecordBatch:
            names = list(held[True].keys() | held[False].keys())
            c = [held[True][w] for w in names]
            n = [x + held[False][w] for x, w in zip(c, names, strict=True)]
            held[True].clear()
            held[False].clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()).cast(pa.string()), pa.array(c, pa.int64()), pa.array(n, pa.int64())], schema=schema)

        for batch in batches:
            for text, trained in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), strict=True):
                count = held[trained]
                count.update(split_words(text.as_py() or b""))
                count[END.encode()] += 1
                if len(count) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    rows = docs.select(F.col("text").cast("string").alias("text"), training_row(folds).alias("trained")).mapInArrow(run, "word string, c long, n long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of ``batches`` in fewer and larger parts."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= TOGETHER or sum(x.nbytes for x in held) >= TOGETHER_BYTES:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def fit_pieces(counts: DataFrame, pieces: list[tuple[str, float]], tokens: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces and of unknown characters."""
    names, logp = [p for p, _ in pieces], starting_probabilities(pieces)
    trained = counts.filter("c > 0").select("word", "c")
    for _ in range(rounds if tokens else 0):
        shared = counts.sparkSession.sparkContext.broadcast((names, logp))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(*shared.value)
            total = np.zeros(lattice.none)
            for batch in joined(batches):
                total += lattice.soft_counts(batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(float))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.float64())], names=["piece", "uses"])

        used = trained.mapInArrow(run, "piece int, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()  # at most a row for each piece
        uses = np.full(len(logp), PIECE_PSEUDO_COUNT)
        for r in used:
            uses[r.piece] += r.uses
        logp = np.log(uses / uses.sum())
    return logp


def with_lattice(counts: DataFrame, pieces: list[tuple[str, float]], logp: np.ndarray) -> DataFrame:
    """``counts`` with ``lattice``, the log10 probability of each word."""
    shared = counts.sparkSession.sparkContext.broadcast(([p for p, _ in pieces], logp))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        for batch in joined(batches):
            yield from batch.append_column("lattice", pa.array(lattice.word_logps(batch.column(0).to_pylist()) / math.log(10))).to_batches()

    return counts.mapInArrow(run, "word string, c long, n long, lattice double")


def score_documents(docs: DataFrame, path: str | None = None, folds: int = FOLDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of each row of (doc_id, text)."""
    spark: SparkSession = docs.sparkSession
    pieces = vocabulary(path)
    counts = materialize(count_words(docs, folds), "word-counts")
    total = counts.agg(F.sum("c").alias("tokens"), F.sum((F.col("c") > 0).cast("long")).alias("distinct"), F.sum("n").alias("all")).first()
    tokens, distinct, everything = (int(x or 0) for x in total)
    known = materialize(with_lattice(counts, pieces, fit_pieces(counts, pieces, tokens)), "word-scores")
    floor = math.log10(tokens + PSEUDO_COUNT * (distinct + 1))

    heavy = known.filter((F.col("n") * HEAVY > everything) & (F.octet_length("word") <= HEAVY_BYTES))
    table = {r.word.encode(): (int(r.c > 0), math.log10(r.c + PSEUDO_COUNT) - floor, r.lattice) for r in heavy.collect()}  # at most HEAVY rows
    shared = spark.sparkContext.broadcast(table)
    kinds = [("doc_id", "long"), ("text_key", "long"), ("word", "string"), ("times", "long"), ("copies", "long"), ("n_tokens", "long"), ("n_known", "long"), ("base", "double"), ("score", "double")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one row without a word for each text, and one for each of its other distinct words
        heavy_words = shared.value
        types = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}

        def frame(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()).cast(pa.string()) if k == "word" else pa.array(x, types[t]) for x, (k, t) in zip(zip(*out, strict=True), kinds, strict=True)], names=[k for k, _ in kinds])

        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                raw = text.as_py() or b""
                key = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)
                words = Counter(split_words(raw))
                words[END.encode()] = 1
                n = sum(words.values())
                there, base, score = 0, 0.0, 0.0
                for word, times in words.items():
                    if (hit := heavy_words.get(word)) is not None:
                        there += times * hit[0]
                        base += times * hit[1]
                        score += times * hit[2]
                    else:
                        out.append((doc, key, word, times, 0, 0, 0, 0.0, 0.0))
                out.append((doc, key, None, 0, 1, n, there, base, score))
                if len(out) > 50_000:
                    yield frame(out)
                    out = []
            if out:
                yield frame(out)

    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ", ".join(f"{k} {t}" for k, t in kinds))
    split = materialize(split, "split")
    rare = split.filter("word is not null").select("doc_id", "text_key", "word", "times").join(known.select("word", "c", "lattice"), "word")
    rare = rare.select(
        "doc_id", "text_key", F.lit(0).cast("long").alias("copies"), F.lit(0).cast("long").alias("n_tokens"),
        (F.col("times") * (F.col("c") > 0).cast("long")).alias("n_known"),
        (F.col("times") * (F.log10(F.col("c") + PSEUDO_COUNT) - floor)).alias("base"), (F.col("times") * F.col("lattice")).alias("score"),
    )
    sums = ("copies", "n_tokens", "n_known", "base", "score")
    both = split.filter("word is null").select("doc_id", "text_key", *sums).unionByName(rare)
    by_text = both.groupBy("doc_id", "text_key").agg(*(F.sum(x).alias(x) for x in sums))
    # rows that repeat an id and a text were added up
    rows = by_text.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(
        "doc_id", (~training_row(folds)).alias("held_out"), (F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"), (F.col("score") / F.col("copies")).alias("score"),
    )
