"""Approximate nearest neighbours by multi-index hashing.

Vectors get binary codes: the signs of several learned rotations (iterative
quantisation on a bounded sample).  So that near codes mean large inner
products, vectors get one component more that makes all norms equal, and
queries a zero there.  A code is cut into substrings, each with an index of its
own; a code within Hamming radius ``r`` of a query must be within ``r // m`` in
one of the ``m`` substrings at least (pigeonhole, with exact remainders), so
probing the substring indexes at those radii retrieves every such code.  What
they retrieve is checked against ``r`` on the whole code, and the rest is ranked
by inner products of the original vectors in double precision.

``r`` is learned on the sample as the radius that holds ``TARGET`` of true
neighbours; a query that finds fewer than ``k`` in a block widens ``r`` there.

Scale: vectors are dealt by hash into blocks of about ``BLOCK``, queries into
chunks; every chunk meets every block in a task of bounded size, and only the
``k`` best of each go on.  No pair of vectors is ever a row.

Defined cases: rows without an id or a usable vector (see ``vectors.usable``)
take no part; vectors of another length than the query's are no candidates (a
search of its own for each length, of which there are few); a query's own id is
no candidate; equal scores go by id; rows that
repeat an id count as one candidate (the first best); with fewer than ``k``
candidates all are returned; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import materialize
from lakestrata.llm.vectors import matrix, usable

BITS = 256
SUBSTRING = 16
TABLES = BITS // SUBSTRING
#: Vectors that rotations and radius are learned from, at most.
SAMPLE_ROWS = 4096
SAMPLE_QUERIES = 256
TARGET = 0.97
ITERATIONS = 20
BLOCK, CHUNK = 4096, 1024
_POPCOUNT = np.array([bin(i).count("1") for i in range(1 << SUBSTRING)], dtype=np.uint8)


def extended(x: np.ndarray, norm: float) -> np.ndarray:
    """Vectors of equal norm: one component more."""
    rest = np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def learn_rotations(x: np.ndarray, bits: int = BITS, seed: int = 5) -> np.ndarray:
    """Columns of rotations whose signs quantise ``x`` well: each starts at a
    random rotation and alternates between codes and the best rotation to them."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = []
    for _ in range(-(-bits // d)):
        r, _ = np.linalg.qr(rng.normal(size=(d, d)))
        for _ in range(ITERATIONS):
            u, _, vt = np.linalg.svd(x.T @ np.where(x @ r > 0, 1.0, -1.0))
            r = u @ vt
        found.append(r)
    return np.concatenate(found, axis=1)[:, :bits]


def codes(x: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    return np.packbits(x @ rotations > 0, axis=1).view(np.uint16)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _POPCOUNT[a ^ b].sum(axis=-1, dtype=np.int32)


def learn_radius(x: np.ndarray, extended_x: np.ndarray, rotations: np.ndarray, k: int, rows: int) -> int:
    """The radius that holds ``TARGET`` of the neighbours of sampled queries.
    The sample's ``k`` nearest are scaled down to the ranks that are as near in
    the sample as ``k`` is among all ``rows``."""
    near = min(len(x) - 1, max(3, -(-k * len(x) // max(rows, 1))))
    if near < 1:
        return BITS
    q = np.arange(min(SAMPLE_QUERIES, len(x)))
    score = x[q] @ x.T
    score[q, q] = -np.inf
    best = np.argpartition(-score, near - 1, axis=1)[:, :near]
    there = codes(extended_x, rotations)
    asked = codes(np.pad(x[q], ((0, 0), (0, 1))), rotations)
    return int(np.quantile(hamming(asked[:, None, :], there[best]), TARGET, method="higher"))


class MultiIndex:
    """The substring indexes of one block of codes."""

    def __init__(self, code: np.ndarray):
        self.code = code
        self.tables = []
        for j in range(code.shape[1]):
            order = np.argsort(code[:, j], kind="stable")
            values, counts = np.unique(code[:, j], return_counts=True)
            self.tables.append((order, values, counts))

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code is within ``radius`` of the query's."""
        m = len(self.tables)
        part, extra = divmod(radius, m)
        seen = np.zeros(len(self.code), dtype=bool)
        for j, (order, values, counts) in enumerate(self.tables):
            near = _POPCOUNT[values ^ query[j]] <= part - (j > extra)
            seen[order[np.repeat(near, counts)]] = True
        found = np.flatnonzero(seen)
        return found[hamming(self.code[found], query) <= radius]


def best_first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best ids: by score, then by id; each id once."""
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)][:k]


def search(embeddings: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``embeddings``
    (vec_id, embedding) to each row of ``queries`` (alike)."""
    base = materialize(usable(embeddings).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")), "vectors")
    asked = materialize(usable(queries).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")), "queries")
    length = F.size("embedding")
    lengths = base.select(length.alias("n")).distinct().join(asked.select(length.alias("n")).distinct(), "n").orderBy("n").collect()
    if not lengths:
        return base.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, [search_length(base.filter(length == r.n), asked.filter(length == r.n), k) for r in lengths])


def search_length(base: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``search`` among usable vectors of one length."""
    squares = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x * x)
    rows, norm = base.agg(F.count("*"), F.sqrt(F.max(squares))).first()
    n_queries = asked.count()
    out = "query_id long, vec_id long, score double"
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toArrow()
    sample_x = matrix(sample["embedding"])
    sample_extended = extended(sample_x, norm)
    rotations = learn_rotations(sample_extended)
    shared = base.sparkSession.sparkContext.broadcast((rotations, learn_radius(sample_x, sample_extended, rotations, k, rows), norm))

    blocks, chunks = -(-rows // BLOCK), -(-n_queries // CHUNK)
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = base.withColumn("block", own(blocks)).withColumn("chunk", every(chunks)).withColumn("asks", F.lit(False))
    asking = asked.withColumn("chunk", own(chunks)).withColumn("block", every(blocks)).withColumn("asks", F.lit(True))

    def run(group: pa.Table) -> pa.Table:
        rotations, radius, norm = shared.value
        asks = group["asks"].to_numpy()
        ids, x = group["vec_id"].to_numpy(), matrix(group["embedding"])
        there_ids, there = ids[~asks], x[~asks]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(there):
            index = MultiIndex(codes(extended(there, norm), rotations))
            for i, code in zip(np.flatnonzero(asks), codes(np.pad(x[asks], ((0, 0), (0, 1))), rotations), strict=True):
                r = radius
                while True:
                    near = index.within(code, r)
                    near = near[there_ids[near] != ids[i]]
                    if len(near) >= k or r >= BITS:
                        break
                    r = min(BITS, r + TABLES)
                scores = (there[near] * x[i]).sum(axis=1)
                best = best_first(there_ids[near], scores, k)
                found.append((np.full(len(best), ids[i]), there_ids[near][best], scores[best]))
        parts = [np.concatenate(z) for z in zip(*found, strict=True)] if found else [[], [], []]
        return pa.table({"query_id": pa.array(parts[0], pa.int64()), "vec_id": pa.array(parts[1], pa.int64()), "score": pa.array(parts[2], pa.float64())})

    hits = held.unionByName(asking).groupBy("block", "chunk").applyInArrow(run, out)
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
