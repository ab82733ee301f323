import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakestrata.llm import packing

SCHEMA = "doc_id long, text string"
ODD = [None, "", "   ", "It's DON'T, 12 3.4!", "É. ÉTÉ x", "İstanbul. ΣΑΣ. ß ẞ ŉ áb", "<|endoftext|> a<|startoftext|>", "z\x1cx\x85y\x0bz.w", "." * 50, "a,b;c:d", "語 語。", "x" * 9000]


def ids(text):
    t = Tokenizer.from_file(packing.vocabulary_path())
    t.encode_special_tokens = True
    return [*(t.encode(text, add_special_tokens=False).ids if text else []), 2]


def naive(lengths, capacity):
    bins, offsets, free = np.zeros(len(lengths), int), np.zeros(len(lengths), int), []
    for i in np.argsort(-lengths, kind="stable"):
        at = next((b for b, f in enumerate(free) if f >= lengths[i]), len(free))
        free += [capacity] * (at == len(free))
        bins[i], offsets[i] = at, capacity - free[at]
        free[at] -= lengths[i]
    return bins, offsets


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_tournament_tree_is_first_fit_decreasing(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    for got, want in zip(packing.first_fit_decreasing(lengths, 40), naive(lengths, 40), strict=True):
        assert got.tolist() == want.tolist()


def check(out, rows, sequence):
    want = sorted((d if d is not None else -1, at, len(x[at : at + sequence]), zlib.crc32(np.array(x[at : at + sequence], dtype="<u4").tobytes()), len(x)) for d, t in rows for x in [ids(t)] for at in range(0, len(x), sequence))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == want
    held = {}
    for r in out:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at  # gapless from 0
            at += length
        assert at <= sequence
    return held


def test_pieces_and_places(spark):
    rows = [(i, t) for i, t in enumerate(ODD * 3)] + [(None, "a b c")] * 2 + [(2**60, "big id")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS sequence_id", "2 AS offset", "3 AS __group")
    held = check(packing.pack(df, sequence=64, group_pieces=16).collect(), rows, 64)
    assert len(held) > 1


def test_little_padding(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    out = packing.pack(spark.createDataFrame(rows, SCHEMA)).collect()
    held = check(out, rows, 4096)
    assert sum(r.length for r in out) >= 0.95 * 4096 * (len(held) - 1)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []
