"""How filters over documents interact: what each removes in every order.

A sparse document-term matrix carries the word statistics.  One pass over the
texts splits them into words and dictionary-encodes each shard (a run of
documents with at most ``SHARD_BYTES`` of text); the shards' own dictionaries
are then merged into a global one by word, and the shards' columns renumbered
by it.  Row sums of the matrix are the documents' words, nonzero counts their
distinct words: these decide filters A (few words) and B (repetitive).  The
other flags are read from the text in the same pass: C (capitals), D
(symbols), and E (a text that a smaller ``doc_id`` has) through SHA-256
digests of whole texts.  Documents are counted by part and set of failed
filters; all orders are worked out from these counts alone.

Scale: texts are read once and never shuffled.  A shard's distinct words cross
the network once by word and once back by shard, so that a frequent word counts
once a shard; the global id of a word is its smallest occurrence number, taken
by a window that spills.  The shards meet their ids as packed matrices.  Copies of one text share all flags but E: they are
added up by (digest, part, flags, labels) before the digest's smallest id is
looked for, so that a text with a third of all rows is a handful of rows.
What is left, a count for each part and set of failed filters, is expanded to
600 rows a part.

Defined cases: a null text is an empty one, and two empty texts are identical;
a null ``lang`` counts in part ''; a row without ``doc_id`` has no smaller
twin, is no one's twin and has no label; rows with one ``doc_id`` and text are
counted each, neither is the other's smaller twin; a document with several
label rows is good (toxic) if any of them says so; an empty table has no parts
and gives no rows; other columns are ignored.  A document longer than a shard
is a shard of its own.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import blocks, materialize
from lakestrata.llm.csr import count_matrix, one_list, pack, row_sums, unpack, with_shard_columns

SHARD_BYTES = 6 << 20
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # per cent of the words
MOST_CAPITALS = 3  # per cent of the code points
SYMBOLS = b"#$%&*|"
FILTERS = "ABCDE"
ORDERS = ["".join(x) for x in itertools.permutations(FILTERS)]

ROWS = {"doc_id": pa.int64(), "part": pa.string(), "digest": pa.binary(), "n_points": pa.int64(), "n_capitals": pa.int64(), "has_symbol": pa.bool_()}
ROWS_DDL = "doc_id array<long>, part array<string>, digest array<binary>, n_points array<long>, n_capitals array<long>, has_symbol array<boolean>"
SHARD_DDL = f"shard long, {ROWS_DDL}, cells binary, words array<string>"
# a word's occurrence is numbered by partition, shard of the partition and position in the shard's dictionary
SHARD_BITS, POS_BITS = 13, 28
MATRIX_DDL = f"shard long, {ROWS_DDL}, indptr array<int>, indices array<long>, data array<int>"


def _text_flags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, capitals and whether there is a symbol, of each text."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])[:-1]])
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True

    def total(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags.view(np.uint8), starts, dtype=np.int64)

    return total((joined & 0xC0) != 0x80) - 1, total((joined >= 0x41) & (joined <= 0x5A)), total(symbol[joined]) > 0


def local_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Shards whose columns are numbered within the shard: (shard, the rows'
    lists, cells, words); ``cells`` is the packed matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = shard = TaskContext.get().partitionId() << SHARD_BITS
        for batch, texts in blocks(batches, limit=shard_bytes):
            lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
            encoded = lists.values.dictionary_encode()
            codes, words = encoded.indices.to_numpy(), encoded.dictionary
            rows = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
            del lists, encoded
            # blanks at the ends of a text and empty texts leave an empty word
            empty = pc.index(words, "").as_py()
            if empty >= 0:
                held = codes != empty
                rows, codes = rows[held], codes[held]
                codes = codes - (codes > empty)
                words = words.filter(pc.not_equal(words, ""))
            if len(words) >> POS_BITS or shard - first >> SHARD_BITS:
                raise OverflowError("too many words in a shard, or shards in a partition")
            cells = pack(*count_matrix(rows, codes, len(texts), len(words)))
            points, capitals, symbol = _text_flags(texts)
            digest = pa.array([hashlib.sha256(x).digest() for x in texts], pa.binary())
            own = [batch.column(0), batch.column(1), digest, points, capitals, symbol]
            out = [one_list(x, kind) for x, kind in zip(own, ROWS.values(), strict=True)]
            out = [pa.array([shard], pa.int64()), *out, pa.array([cells], pa.binary()), one_list(words, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["shard", *ROWS, "cells", "words"])
            shard += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SHARD_DDL)


def global_dictionary(shards: DataFrame) -> DataFrame:
    """(word, occurrence, word_id) for each word of each shard.  The id is the
    smallest occurrence of the word, and so the same wherever it occurs."""
    found = shards.select("shard", F.posexplode("words").alias("pos", "word"))
    found = found.select("word", (F.shiftleft("shard", POS_BITS) + F.col("pos")).alias("occurrence"))
    return found.withColumn("word_id", F.min("occurrence").over(Window.partitionBy("word")))


def _encoded(docs: DataFrame, finish: Callable[[dict, tuple], dict], ddl: str, shard_bytes: int) -> DataFrame:
    """``finish(the rows' lists, the matrix by global word ids)`` of each shard."""
    shards = materialize(local_shards(docs, shard_bytes), "document-terms")
    columns = global_dictionary(shards).select(F.shiftright("occurrence", POS_BITS).alias("shard"), F.col("occurrence").alias("pos"), "word_id")

    def run(shard: pa.Table, columns: pa.Table) -> pa.Table:
        indptr, indices, data = unpack(shard["cells"][0].as_py())
        rows = {c: shard[c].combine_chunks() for c in ("shard", *ROWS)}
        return pa.table(finish(rows, (indptr, columns["word_id"].to_numpy()[indices], data)))

    return with_shard_columns(shards.drop("words"), columns, run, ddl)


def document_terms(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The document-term matrix in shards, columns being global word ids:
    (shard, the rows' lists, indptr, indices, data)."""

    def finish(rows: dict, matrix: tuple) -> dict:
        kinds = {"indptr": pa.int32(), "indices": pa.int64(), "data": pa.int32()}
        return rows | {c: one_list(x, kind) for x, (c, kind) in zip(matrix, kinds.items(), strict=True)}

    return _encoded(docs, finish, MATRIX_DDL, shard_bytes)


def document_statistics(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, part, digest, n_points, n_capitals, has_symbol, n_words,
    n_distinct) of each document, from the rows of the matrix."""

    def finish(rows: dict, matrix: tuple) -> dict:
        indptr, _, data = matrix
        out = {c: rows[c].flatten() for c in ROWS}
        return out | {"n_words": row_sums(indptr, data), "n_distinct": np.diff(indptr).astype(np.int64)}

    ddl = "doc_id long, part string, digest binary, n_points long, n_capitals long, has_symbol boolean, n_words long, n_distinct long"
    return _encoded(docs, finish, ddl, shard_bytes)


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def _bits(letters: Column) -> Column:
    return sum((F.when(F.instr(letters, x) > 0, F.lit(_bit(x))).otherwise(F.lit(0)) for x in FILTERS), F.lit(0))


def failed_sets(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(part, failed, n, good, toxic): documents by part and set of failed
    filters (bits of ``failed``, A being 1)."""
    rows = document_statistics(docs, shard_bytes)
    fails = {
        "A": F.col("n_words") < LEAST_WORDS,
        "B": 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"),
        "C": 100 * F.col("n_capitals") > MOST_CAPITALS * F.col("n_points"),
        "D": F.col("has_symbol"),
    }
    mask = sum((F.when(c, F.lit(_bit(x))).otherwise(F.lit(0)) for x, c in fails.items()), F.lit(0))
    rows = rows.select("doc_id", "part", "digest", mask.alias("failed")).groupBy("doc_id", "part", "digest", "failed").agg(F.count("*").alias("n"))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("string").alias("__key"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # rows without an id meet no label; their keys differ by text, which spreads them
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.hex("digest")))
    rows = rows.withColumn("__key", key).join(marks, "__key", "left").withColumns({x: F.coalesce(x, F.lit(0)) for x in ("good", "toxic")})
    kinds = ["part", "digest", "failed", "good", "toxic"]
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    kinds_of_text = rows.groupBy(*kinds).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without_id"), first.alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    fresh = F.col("without_id") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    sets = kinds_of_text.withColumn("fresh", fresh).select(
        "part", "good", "toxic", F.explode(F.array(F.struct("failed", F.col("fresh").alias("n")), F.struct((F.col("failed") + _bit("E")).alias("failed"), (F.col("n") - F.col("fresh")).alias("n")))).alias("set")
    )
    n = F.col("set.n")
    return sets.groupBy("part", F.col("set.failed").alias("failed")).agg(F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def audit(sets: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step."""
    own = _bits(F.substring("filter_order", F.col("step"), F.lit(1)))
    before = _bits(F.expr("substring(filter_order, 1, step - 1)"))
    grid = sets.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    grid = grid.withColumn("own", own).withColumn("before", before)
    hit, gone = F.col("failed").bitwiseAND(F.col("own")) != 0, F.col("failed").bitwiseAND(F.col("before")) != 0

    def total(where: Column, what: str = "n") -> Column:
        return F.sum(F.when(where, F.col(what)).otherwise(F.lit(0)))

    first_in = (F.lit(len(ORDERS)) / F.greatest(F.bit_count("failed"), F.lit(1))).cast("long")  # orders in which a failed filter comes first
    return grid.groupBy("part", "filter_order", "step").agg(
        total(~hit & ~gone).alias("kept"),
        total(hit & ~gone).alias("removed"),
        total(hit & gone).alias("redundant"),
        total(F.col("failed") == F.col("own")).alias("unique_fails"),
        total(hit & ~gone, "good").alias("good_lost"),
        total(hit & ~gone, "toxic").alias("toxic_lost"),
        F.sum(F.when(hit, F.col("n") * first_in).otherwise(F.lit(0))).alias("shapley"),
    )


def filter_interactions(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley)."""
    return audit(failed_sets(docs, labels, shard_bytes))
