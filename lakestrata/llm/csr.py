"""Sparse count matrices in shards (compressed sparse rows).

A shard holds the rows of a bounded run of documents: ``indptr`` (row starts,
one more than rows), ``indices`` (columns) and ``data`` (counts).  Columns are
numbered within the shard first; ``with_shard_columns`` then gives a shard what
the whole corpus knows of each of its columns.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def count_matrix(rows: np.ndarray, columns: np.ndarray, n_rows: int, n_columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indptr, indices, data) of how often each (row, column) occurs."""
    keys = rows.astype(np.int64) * max(1, n_columns) + columns
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    row, indices = np.divmod(keys[first], max(1, n_columns))
    data = np.diff(first, append=len(keys))
    return np.searchsorted(row, np.arange(n_rows + 1)), indices, data


def pack(indptr: np.ndarray, indices: np.ndarray, data: np.ndarray) -> bytes:
    """The matrix in one compressed value: row lengths, steps between columns, counts."""
    raw = np.concatenate([[len(indptr) - 1], np.diff(indptr), np.diff(indices, prepend=0), data]).astype("<i4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = pa.Codec("zstd").decompress(memoryview(packed)[8:], int.from_bytes(packed[:8], "little"))
    values = np.frombuffer(raw, dtype="<i4")
    rows, cells = values[1 : 1 + values[0]], values[1 + values[0] :]
    steps, data = np.split(cells, 2)
    return np.concatenate([[0], np.cumsum(rows)]), np.cumsum(steps), data


def row_sums(indptr: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each row (0 for empty rows)."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[indptr[1:]] - total[indptr[:-1]]


def one_list(values: np.ndarray | pa.Array, kind: pa.DataType) -> pa.Array:
    """A list column of one row."""
    flat = pa.array(values, kind) if isinstance(values, np.ndarray) else values.cast(kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def with_shard_columns(shards: DataFrame, columns: DataFrame, finish: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``finish(shard, its columns in order)`` for each shard: ``columns`` has
    rows (shard, pos, ...), one for each column of each shard."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return finish(left, right.sort_by("pos"))

    columns = columns.withColumnRenamed("shard", "of_shard")
    return shards.groupBy("shard").cogroup(columns.groupBy("of_shard")).applyInArrow(run, schema)
