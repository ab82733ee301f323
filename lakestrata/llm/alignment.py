"""Aligning the tokens that two tokenizers give one text.

Tokens of A (byte-level BPE of a space and the text) and of B (sentencepiece of
the text, which adds that space) are byte intervals that tile the same bytes.
All intervals are sorted by start (``lexsort``), a running maximum of their
ends (``maximum.accumulate``) is kept, and a group begins wherever a start
reaches it: those are the offsets at which tokens of both end.  Within a group
every pair of overlapping tokens is expanded; those that end together are the
links.  Links are counted by id pair over the corpus, and each document is
told how many of its links are the most frequent one of their B id.

Both tokenizers decide the text between two blanks alone: A starts a token at
a blank that follows a letter, digit or mark, and no piece of B holds a blank
after anything else.  So a text is cut there into chunks, which a bounded table
encodes once.

Scale: texts are read once and never shuffled.  A shard (a run of documents of
at most ``SHARD_BYTES``) holds its links as a sparse matrix documents x id
pairs; its distinct pairs cross the network to be counted, and back with their
counts.  A frequent pair counts once a shard.  Pair counts are added up map-side
before the largest of a B id is looked for; ids are bounded by the
vocabularies.  Texts longer than a block are taken in pieces.

Defined cases: a null or empty text, or one whose joined token bytes differ
from the space and the text (U+2581 in it, say), has no tokens: zeros and an
empty digest.  Strings of special tokens are plain text.  Rows that repeat are
counted each; ties for the largest count are all best; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import BLOCK_BYTES, blocks, materialize
from lakestrata.llm.csr import one_list, row_sums, with_shard_columns

SHARD_BYTES = 8 << 20
TABLE_TOKENS = 6_000_000  # of chunks kept by a task
TABLE_CHARS = 24_000_000
COMPACT = 4_000_000  # counts of a shard that are held before they are added up

COUNTS = ("n_a", "n_b", "n_groups")
SHARD_DDL = "shard long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, indptr array<int>, indices array<int>, data array<int>, pairs array<long>, counts array<long>"
OUT_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_CLOSED = re.compile(r"[\w!-~]")
_CUT = re.compile(r"(?<=[\w!-~]) ")


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def split_chunks(text: str) -> list[str]:
    """The text between blanks after which both tokenizers start anew; each
    chunk stands for a blank and itself."""
    parts = text.split(" ")
    out, start = [], 0
    for i, part in enumerate(parts):
        if part and _CLOSED.match(part[-1]):
            out.append(part if start == i else " ".join(parts[start : i + 1]))
            start = i + 1
    if start < len(parts):
        out.append(" ".join(parts[start:]))
    return out


def long_pieces(text: str, limit: int) -> Iterator[str]:
    """Pieces of about ``limit`` code points, cut where chunks are."""
    start = 0
    while len(text) - start > limit and (cut := _CUT.search(text, start + limit)):
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


def take(offsets: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Positions of all items of the rows, where row r has ``counts[r]`` from ``offsets[r]``."""
    n = counts[rows]
    ends = np.cumsum(n)
    return np.repeat(offsets[rows] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


class Tokens:
    """Ids and byte lengths of the chunks' tokens, flat, by one tokenizer."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths  # bytes by id
        self.ids, self.counts, self.offsets = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, ids: list[list[int]]) -> None:
        flat = np.fromiter((x for row in ids for x in row), dtype=np.int64)
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        self.offsets = np.concatenate([self.offsets, len(self.ids) + np.cumsum(counts) - counts])
        self.ids, self.counts = np.concatenate([self.ids, flat]), np.concatenate([self.counts, counts])


class ChunkTable:
    """Numbers chunks and keeps their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        # byte-level alphabet: printable bytes stand for themselves, the others for U+0100 and on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(x): x for x in plain} | {chr(0x100 + i): x for i, x in enumerate(sorted(set(range(256)) - set(plain)))}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token)
        self.n_b, self.blank = self.b.get_piece_size(), [self.b.piece_to_id("▁")]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(map(self.b.id_to_piece, range(self.n_b)))]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.sides = [Tokens(np.array([len(x) for x in table], dtype=np.int64)) for table in (self.a_bytes, self.b_bytes)]
        self.sound = np.zeros(0, dtype=bool)

    def full(self) -> bool:
        return self.chars > TABLE_CHARS or sum(len(x.ids) for x in self.sides) > TABLE_TOKENS

    def numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Numbers of the chunks of each text."""
        known = self.known
        fresh = list(set().union(*texts).difference(known))
        if fresh:
            known.update(zip(fresh, range(len(known), len(known) + len(fresh)), strict=True))
            self.chars += sum(map(len, fresh))
            a = [x.ids for x in self.a.encode_batch([" " + x for x in fresh], add_special_tokens=False)]
            b = [ids or self.blank for ids in self.b.encode(fresh, num_threads=1)]  # nothing is added to an empty text
            self.sides[0].add(a)
            self.sides[1].add(b)
            a_bytes, b_bytes = self.a_bytes, self.b_bytes
            sound = [b"".join([a_bytes[i] for i in x]) == raw == b"".join([b_bytes[i] for i in y]) for x, y, raw in zip(a, b, (b" " + x.encode() for x in fresh), strict=True)]
            self.sound = np.concatenate([self.sound, np.array(sound, dtype=bool)])
        return [np.fromiter(map(known.__getitem__, x), dtype=np.int64, count=len(x)) for x in texts]


def coalesce(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of A's and of B's intervals."""
    starts, ends = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    new = np.ones(len(order), dtype=np.int64)
    new[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return group[: len(a_start)], group[len(a_start) :]


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (position in A, position in B) of overlapping intervals, by B."""
    first, last = np.searchsorted(a_end, b_start, "right"), np.searchsorted(a_start, b_end, "left")
    n = last - first
    ends = np.cumsum(n)
    return np.repeat(first - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0), np.repeat(np.arange(len(b_start)), n)


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. n - 1 and a column for what follows them; their number."""
    text = np.char.mod("%d", np.arange(n)).astype(bytes)
    width = text.dtype.itemsize
    table = np.zeros((n, width + 1), dtype=np.uint8)
    table[:, :width] = text.view(np.uint8).reshape(n, width)
    return table, np.char.str_len(text)


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.table = ChunkTable(a_path, b_path)
        self.digits, _ = _digits(max(len(self.table.a_bytes), self.table.n_b))

    def groups_text(self, ids: np.ndarray, group: np.ndarray, side: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;a3|b2`` of each row (flat bytes, and how many of each token)."""
        order = np.argsort(2 * group + side, kind="stable")
        ids, group, side, row = ids[order], group[order], side[order], row[order]
        after = np.full(len(ids), ord(","), dtype=np.uint8)
        after[:-1][side[:-1] < side[1:]] = ord("|")
        after[:-1][group[:-1] != group[1:]] = ord(";")
        after[np.flatnonzero(np.diff(row, append=-1))] = 0
        cells = self.digits[ids]
        cells[:, -1] = after
        used = cells != 0
        return cells[used], np.bincount(row, weights=used.sum(axis=1)).astype(np.int64)

    def align(self, chunks: list[np.ndarray]) -> dict[str, np.ndarray | list]:
        """For each text: counts, the groups' text, and its links as (row, a, b)."""
        rows = np.repeat(np.arange(len(chunks)), [len(x) for x in chunks])
        chunks = np.concatenate(chunks) if chunks else np.zeros(0, dtype=np.int64)
        ids, starts, ends, where = [], [], [], []
        for side in self.table.sides:
            ids.append(side.ids[take(side.offsets, side.counts, chunks)])
            ends.append(np.cumsum(side.lengths[ids[-1]]))
            starts.append(ends[-1] - side.lengths[ids[-1]])
            where.append(np.repeat(rows, side.counts[chunks]))
        group = coalesce(starts[0], ends[0], starts[1], ends[1])
        text, sizes = self.groups_text(np.concatenate(ids), np.concatenate(group), np.repeat([0, 1], [len(x) for x in ids]), np.concatenate(where))
        a, b = overlaps(starts[0], ends[0], starts[1], ends[1])
        together = ends[0][a] == ends[1][b]
        a, b = a[together], b[together]
        n = int(rows[-1]) + 1 if len(rows) else 0
        first = np.flatnonzero(np.diff(group[0], prepend=-1))
        return {
            "n_a": np.bincount(where[0], minlength=n),
            "n_b": np.bincount(where[1], minlength=n),
            "n_groups": np.bincount(where[0][first], minlength=n),
            "text": np.split(text, np.cumsum(np.pad(sizes, (0, n - len(sizes))))[:-1]) if n else [],
            "row": where[1][b],
            "a": ids[0][a],
            "b": ids[1][b],
        }


class Shard:
    """What is known of a shard's documents so far."""

    def __init__(self, n: int, pairs: int):
        self.n, self.pairs = n, pairs
        self.sums = {x: np.zeros(n, dtype=np.int64) for x in COUNTS}
        self.hashes: list = [None] * n
        self.bad = np.zeros(n, dtype=bool)
        self.keys, self.counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]

    def add(self, docs: np.ndarray, found: dict) -> None:
        """Results of texts; several may belong to one document, in order."""
        for x in COUNTS:
            np.add.at(self.sums[x], docs, found[x])
        for doc, text in zip(docs.tolist(), found["text"], strict=True):
            if self.hashes[doc] is None:
                self.hashes[doc] = hashlib.sha256(text)
            else:
                self.hashes[doc].update(b";")
                self.hashes[doc].update(text)
        keys, counts = np.unique(docs[found["row"]] * self.pairs + found["pair"], return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        if sum(map(len, self.keys)) > COMPACT:
            self.compact()

    def compact(self) -> None:
        keys, inverse = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate(self.counts), minlength=len(keys)).astype(np.int64)
        self.keys, self.counts = [keys], [counts]

    def row(self, shard: int, doc_id: pa.Array) -> pa.RecordBatch:
        self.compact()
        row, pair = np.divmod(self.keys[0], self.pairs)
        held = ~self.bad[row]
        row, data = row[held], self.counts[0][held]
        pairs, indices = np.unique(pair[held], return_inverse=True)
        digests = ["" if h is None or bad else h.hexdigest() for h, bad in zip(self.hashes, self.bad.tolist(), strict=True)]
        totals = np.bincount(indices, weights=data, minlength=len(pairs)).astype(np.int64)
        lists = [(doc_id, pa.int64()), *((np.where(self.bad, 0, self.sums[x]), pa.int64()) for x in COUNTS), (pa.array(digests, pa.string()), pa.string())]
        lists += [(np.searchsorted(row, np.arange(self.n + 1)), pa.int32()), (indices, pa.int32()), (data, pa.int32()), (pairs, pa.int64()), (totals, pa.int64())]
        names = [x.split(" ")[0] for x in SHARD_DDL.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), *(one_list(x, kind) for x, kind in lists)], names=names)


def link_shards(docs: DataFrame, paths: tuple[str, str] | None = None, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each shard: its documents' counts, and its links as a sparse
    matrix documents x ``pairs`` (a id times B's vocabulary size, plus b id)."""
    a_path, b_path = paths or vocabulary_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        table = aligner.table
        number = TaskContext.get().partitionId() << 32
        for batch, texts in blocks(batches, limit=shard_bytes):
            shard = Shard(len(texts), len(table.a_bytes) * table.n_b)
            waiting: list[tuple[int, list[str]]] = []
            size = 0

            def settle() -> None:
                if table.full():
                    table.clear()
                numbers = table.numbers([x for _, x in waiting])
                sound = [bool(table.sound[x].all()) for x in numbers]
                for (doc, _), fine in zip(waiting, sound, strict=True):
                    shard.bad[doc] |= not fine
                held = [k for k, fine in enumerate(sound) if fine]
                if held:
                    found = aligner.align([numbers[k] for k in held])
                    found["pair"] = found["a"] * table.n_b + found["b"]
                    shard.add(np.array([waiting[k][0] for k in held]), found)
                waiting.clear()

            for doc, raw in enumerate(texts):
                text = raw.decode()
                for piece in long_pieces(text, block_bytes) if text else ():
                    waiting.append((doc, split_chunks(piece)))
                    size += len(piece)
                    if size >= block_bytes:
                        settle()
                        size = 0
            if waiting:
                settle()
            yield shard.row(number, batch.column(0))
            number += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SHARD_DDL)


def pair_counts(shards: DataFrame, n_b: int) -> DataFrame:
    """(pair, a_id, b_id, n, best): links of each id pair in the corpus; ``best``
    where no other A id is linked more often with the B id."""
    found = shards.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    totals = found.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("n"))
    totals = totals.select("pair", F.expr(f"pair div {n_b}").alias("a_id"), (F.col("pair") % n_b).alias("b_id"), "n")
    return totals.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b_id")))


def align_documents(docs: DataFrame, paths: tuple[str, str] | None = None, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    from sentencepiece import SentencePieceProcessor

    paths = paths or vocabulary_paths()
    n_b = SentencePieceProcessor(model_file=paths[1]).get_piece_size()
    shards = materialize(link_shards(docs, paths, shard_bytes, block_bytes), "links")
    held = shards.select("shard", F.posexplode("pairs").alias("pos", "pair"))
    columns = held.join(pair_counts(shards, n_b).select("pair", "n", "best"), "pair").select("shard", "pos", "n", F.col("best").cast("int").alias("best"))

    def finish(shard: pa.Table, columns: pa.Table) -> pa.Table:
        lists = {c: shard[c].combine_chunks().flatten() for c in shard.column_names if c != "shard"}
        indptr, indices, data = (lists[c].to_numpy() for c in ("indptr", "indices", "data"))
        n, best = (columns[c].to_numpy().astype(np.int64) for c in ("n", "best"))
        out = {c: lists[c] for c in ("doc_id", *COUNTS)}
        out["n_links"] = row_sums(indptr, data)
        out["n_best"] = row_sums(indptr, data * best[indices])
        out["count_sum"] = row_sums(indptr, data * n[indices])
        out["groups_sha256"] = lists["groups_sha256"]
        return pa.table(out)

    return with_shard_columns(shards.drop("pairs", "counts"), columns, finish, OUT_DDL)
