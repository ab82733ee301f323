"""Packing documents into training sequences: first-fit decreasing.

A document's tokens and one end id are cut into pieces of the sequence length
and a remainder.  Pieces are dealt at random into groups of bounded size, and
each group is packed on its own by first-fit decreasing; the first sequence
with room is found by a tournament tree whose nodes hold the largest free
capacity below them, in ``log(sequences)`` steps.

Scale: tokenising is row by row; only piece records (numbers) are shuffled,
never token ids.  Group sizes are random numbers around ``GROUP_PIECES``
whatever the data, as each piece is dealt alone; a long document's pieces
spread over groups.  Padding does not grow with the number of groups beyond
the last, partly filled sequences of each.

Defined cases: a null or empty text is the end id alone; text ids are those of
the tokenizer with special strings read as ordinary text; repeated rows are
packed each; an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import BLOCK_BYTES, blocks, materialize, worker_cache

SEQUENCE = 4096
END_ID = 2
GROUP_PIECES = 2048
CACHED_CHUNKS = 700_000  # kept by a worker across its tasks, and
CACHED_CHARS = 14_000_000  # their code points
#: Latin letters, which lower case takes one by one, and marks that are one word of the tokenizer's (not ', which may be a contraction's)
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]{0,3})")

PIECE = pa.schema([(x, pa.int64()) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
PIECE_DDL = ", ".join(f"{x} long" for x in PIECE.names)
PACKED_DDL = f"{PIECE_DDL}, sequence_id long, offset long"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """Token ids of texts, as little-endian 32-bit bytes.  The tokenizer drops
    white space and never joins across it, so ids of the chunks between blanks
    are kept and reused; so are those of words that only differ in case or in
    a few marks at the end, which the tokenizer lower-cases and splits off."""

    def __init__(self, vocabulary: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {"": b""}
        self.once: set[str] = set()  # known chunks that one call has had so far
        self.held = 0  # code points of the known chunks
        self.marks = {"": b""}  # ids of runs of marks
        vocabulary_ids = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary_ids.values()) + 1, dtype=bool)  # ids that end a word
        self.ends[[i for x, i in vocabulary_ids.items() if x.endswith("</w>")]] = True

    def _encode(self, chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch(chunks, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """As ``_encode``, in one call, for words of letters alone: each gives
        ids of which the last, and only that, ends a word."""
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, dtype="<u4")
        cuts = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _learn(self, fresh: set[str]) -> None:
        """Adds chunks, and the lower-case words that they hold."""
        known, marks, match = self.known, self.marks, PLAIN.fullmatch
        plain: dict[str, tuple[str, str]] = {}
        other: list[str] = []
        for chunk in fresh:
            if found := match(chunk):
                plain[chunk] = found[1].lower(), found[2]
            else:
                other.append(chunk)
        words = list({x for x, _ in plain.values()}.difference(known))
        if runs := list({x for _, x in plain.values()}.difference(marks)):
            marks.update(zip(runs, self._encode(runs), strict=True))
        known.update(zip(words, self._encode_words(words), strict=True))
        self.once.update(fresh, words)
        self.held += sum(map(len, fresh)) + sum(map(len, words))
        known.update(zip(other, self._encode(other), strict=True))
        for chunk, (word, mark) in plain.items():
            known[chunk] = known[word] + marks[mark]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of the texts; what is not known of their words is learned in one go."""
        split = [x.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for x in texts]
        chunks = set().union(*split)
        self.once -= chunks
        if len(self.known) > CACHED_CHUNKS or self.held > CACHED_CHARS:
            self._forget()
        fresh = chunks.difference(self.known)
        self._learn(fresh)
        return [b"".join(map(self.known.__getitem__, x)) for x in split]

    def _forget(self) -> None:
        """Drops the chunks that only one call had, most of them for good; all, if those are few."""
        if 2 * len(self.once) < len(self.known):
            self.known = {"": b""}
        else:
            for chunk in self.once:
                del self.known[chunk]
        self.once.clear()
        self.held = sum(map(len, self.known))


def cut_documents(docs: DataFrame, vocabulary: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each row of (doc_id, text)."""
    vocabulary = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache()
        encode = cache.get(vocabulary) or cache.setdefault(vocabulary, ChunkEncoder(vocabulary))
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch, raw in blocks(batches, limit=BLOCK_BYTES, keep_cache=True):
            out: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode([x.decode() for x in raw]), strict=True):
                ids += end
                for at in range(0, len(ids), 4 * sequence):
                    piece = ids[at : at + 4 * sequence]
                    out.append((doc, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], schema=PIECE)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECE_DDL)


class CapacityTree:
    """Tournament tree of the free room of up to ``n`` bins."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Puts ``size`` into the first bin with room: (bin, free before)."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        before = room[at]
        room[at] -= size
        found = at - self.leaves
        at //= 2
        while at:
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
            at //= 2
        return found, before


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; items longer than the capacity are an error."""
    if len(lengths) and lengths.max() > capacity:
        raise ValueError("an item is longer than a bin")
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    tree = CapacityTree(max(1, len(lengths)), capacity)
    for i in np.argsort(-lengths, kind="stable"):
        bins[i], before = tree.place(int(lengths[i]))
        offsets[i] = capacity - before
    return bins, offsets


def pack(docs: DataFrame, vocabulary: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID, group_pieces: int = GROUP_PIECES, seed: int = 29) -> DataFrame:
    """Pieces of all documents with their place: (doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset)."""
    pieces = materialize(cut_documents(docs, vocabulary, sequence, end_id), "pieces")
    groups = max(1, math.ceil(pieces.count() / group_pieces))

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.drop_columns(["__group"]).sort_by([(x, "ascending") for x in ("doc_id", "start", "ids_crc32")])
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), sequence)
        sequences = (key[0].as_py() << 32) + bins
        return group.append_column("sequence_id", pa.array(sequences)).append_column("offset", pa.array(offsets))

    dealt = pieces.withColumn("__group", F.floor(F.rand(seed) * groups).cast("long"))
    return dealt.groupBy("__group").applyInArrow(run, PACKED_DDL)
