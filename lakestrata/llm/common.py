"""Helpers shared by the operators: tables, scratch tables, text batches."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.session import confirm_scratch, ensure_checkpoint_dir

#: UTF-8 bytes of text that a Python worker turns into arrays at a time.
BLOCK_BYTES = 1 << 20

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` once into the shared checkpoint folder and
    read it back.  The files go when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakestrata-llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    confirm_scratch(spark, path)
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def worker_cache() -> dict:
    """What a Python worker keeps between its tasks (functions come by value,
    so that their modules' globals don't last)."""
    held = sys.modules.setdefault("_lakestrata_worker_cache", types.ModuleType("_lakestrata_worker_cache"))
    return held.__dict__.setdefault("kept", {})


def drop_worker_cache() -> None:
    """Frees what a worker keeps, and hands the memory back to the system."""
    if cache := worker_cache():
        cache.clear()
        gc.collect()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library: the memory stays with the worker
            pass


def own_columns_win(df: DataFrame, own: Iterable[str]) -> DataFrame:
    """Drop input columns whose names an operator uses for its own output
    (names compare without case, as Spark's do)."""
    taken = {c.lower() for c in own}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES, keep_cache: bool = False) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches whose texts hold about ``limit`` bytes, with the
    texts as UTF-8 (null: empty).  One longer text makes a slice of its own.
    What another operator left in the worker's cache goes first."""
    if not keep_cache:
        drop_worker_cache()
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        start = size = 0
        held: list[bytes] = []
        for i in range(batch.num_rows):
            raw = texts[i].as_py() or b""
            if held and size + len(raw) > limit:
                yield batch.slice(start, i - start), held
                start, size, held = i, 0, []
            held.append(raw)
            size += len(raw)
        if held:
            yield batch.slice(start), held


def training_row(modulus: int) -> Column:
    """True for rows whose crc32(doc_id as text) mod ``modulus`` is not 0; rows
    without an id are never trained on."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus != 0, F.lit(False))


def first_by_hash(keyed: DataFrame, n: int, per: str | None = None) -> DataFrame:
    """A bounded sample of (doc_id, ...): the ``n`` rows, of each ``per`` if it
    is named, whose ids have the smallest hashes (``__order``); with ``per``, rows
    that repeat count once.  A group's (estimated) size then bounds the hashes that can
    be among its first, so that about ``2 * n`` rows of each are shuffled, however
    large it is; ``n`` is at most 1,000, up to which Spark also limits the rest."""
    keyed = keyed.withColumn("__order", F.xxhash64(F.lit(11), "doc_id"))
    if per is None:
        return keyed.orderBy("__order", "doc_id").limit(n)
    if n > 1000:
        raise ValueError("more than 1,000 rows of a group would all be shuffled to one task")
    # sizes are written first, so that Spark broadcasts them where the file is small
    sizes = materialize(keyed.groupBy(per).agg(F.greatest(F.approx_count_distinct("doc_id"), F.lit(1)).alias("__size")), "group-sizes")
    share = F.col("__order") / F.lit(2.0**64) + 0.5  # uniform in [0, 1]
    keyed = keyed.join(sizes, per).filter(share * F.col("__size") <= 2 * n).drop("__size").distinct()
    rank = F.row_number().over(Window.partitionBy(per).orderBy("__order", "doc_id"))
    return keyed.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(64, dtype=np.uint64)
np.multiply.accumulate(np.full(63, _BASE), out=_POWERS[1:])


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        more = np.full(2 * n, _BASE, dtype=np.uint64)
        more[0] = 1
        _POWERS = np.multiply.accumulate(more)
    return _POWERS


def word_hashes(texts: list[bytes], gaps: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order (A-Z lower-cased), and
    ``len(texts) + 1`` offsets of each text's words.  ``gaps`` says for each
    byte whether it separates words: ``[\\x20\\x09-\\x0D]``, if not given."""
    joined = np.frombuffer(b"\n".join(x.lower() for x in texts) + b"\n", dtype=np.uint8)
    gap = gaps[joined]
    edge = np.flatnonzero(np.diff(gap.astype(np.int8), prepend=np.int8(1)))
    starts, ends = edge[0::2], edge[1::2]
    text_ends = np.cumsum([len(x) + 1 for x in texts])
    offsets = np.concatenate([[0], np.searchsorted(starts, text_ends)]).astype(np.int64)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), offsets
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    where = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    terms = (joined[~gap].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[where]
    return mix64(np.add.reduceat(terms, first) + lengths.astype(np.uint64)), offsets
