import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from lakestrata.llm import alignment

SCHEMA = "doc_id long, text string"
A_PATH, B_PATH = alignment.vocabulary_paths()
A, B = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
A.encode_special_tokens = True
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "It's a test, isn't it?", "Ünïcödé  naïve façade — “quoted”…", "語 語。 日本語のテキスト", "a▁b", "▁", "x  y", "x \n\ny z",
    "tab\there\nline\r\n\n  end ", "<|endoftext|> </s> <s> <unk> <0x0A> [INST]", "a\u0000b c", "́ combining é", "ﬁ ligature Ⅳ ½ ²", "Привет мир как дела", "नमस्ते दुनिया", "😀 😀😀 👩‍👩‍👧", "　wide　 blank", "x" * 3000, "1234567 89.5 $3",
    "\x1c \x1d x\x85 y\x0b z", "İstanbul ΣΑΣ ß", "end​ ​zero", "﻿bom ﻿", "    four    spaces    ", "'s 't 're it's", "é e ́", "    x", "a" + " " * 40 + "b",
]


def tokens_a(text):
    ids = A.encode(" " + text, add_special_tokens=False).ids
    unbyte = {c: b for b, c in byte_level().items()}
    return ids, [bytes(unbyte[c] for c in A.id_to_token(i)) for i in ids]


def byte_level():
    """Byte -> character, read off the library itself."""
    out = {}
    for x in range(256):
        if x < 0x80:
            out[x] = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(x))[0][0]
    for x in range(0x80, 0x800):
        for raw, c in zip(chr(x).encode(), ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(x))[0][0], strict=True):
            out[raw] = c
    for x in (0x800, 0x1000, 0x2000, 0x3000, 0x4000, 0x5000, 0x6000, 0x7000, 0x8000, 0x9000, 0xA000, 0xB000, 0xC000, 0xD000, 0xE000, 0xF000, 0x10000, 0x40000, 0x80000, 0xC0000, 0x100000):
        for raw, c in zip(chr(x).encode(), ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(x))[0][0], strict=True):
            out[raw] = c
    return out


def tokens_b(text):
    ids = B.encode(text)
    return ids, [bytes([int(p[3:-1], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, map(B.id_to_piece, ids), strict=True)]


def brute(rows):
    docs = []
    for d, text in rows:
        text = text or ""
        (a, ab), (b, bb) = (tokens_a(text), tokens_b(text)) if text else (([], []), ([], []))
        if not text or b"".join(ab) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            docs.append((d, [], [], "", []))
            continue
        a_end, b_end = (np.cumsum([len(x) for x in y]).tolist() for y in (ab, bb))
        cuts = sorted(set(a_end) & set(b_end))
        groups, last = [], 0
        for cut in cuts:
            groups.append(",".join(str(i) for i, e in zip(a, a_end, strict=True) if last < e <= cut) + "|" + ",".join(str(i) for i, e in zip(b, b_end, strict=True) if last < e <= cut))
            last = cut
        links = [(a[a_end.index(c)], b[b_end.index(c)]) for c in cuts]
        docs.append((d, a, b, ";".join(groups), links))
    n = Counter(x for y in docs for x in y[4])
    best = {}
    for (_, b), k in n.items():
        best[b] = max(k, best.get(b, 0))
    return sorted(
        (d if d is not None else -1, len(a), len(b), len(links), len(links), sum(n[x] == best[x[1]] for x in links), sum(n[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if links else "")
        for d, a, b, g, links in docs
    )


def run(spark, rows, **more):
    out = alignment.align_documents(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS shard", "2 AS n_a", "3 AS pos"), **more).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, *list(r)[1:]) for r in out)


def test_equals_brute_force(spark):
    rows = list(enumerate(ODD)) + [(3, "a  b"), (None, "It's me"), (2**60, "big id")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows * 2, shard_bytes=60, block_bytes=8) == brute(rows * 2)


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()][:60]
    rows = [(d, t if t is None else t[:3000]) for d, t in rows]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


ALPHABET = st.text(st.sampled_from(list("ab 'sé\n\t.▁ 語1T  e")), max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(ALPHABET, max_size=6))
def test_chunks_give_the_tokens_of_the_whole_text(texts):
    table = alignment.ChunkTable(A_PATH, B_PATH)
    for text, numbers in zip(texts, table.numbers([alignment.split_chunks(x) if x else [] for x in texts]), strict=True):
        a, b = (side.ids[alignment.take(side.offsets, side.counts, numbers)].tolist() for side in table.sides)
        if text:
            assert a == tokens_a(text)[0]
            assert b == tokens_b(text)[0]
        assert "".join(" " + x for x in alignment.split_chunks(text)) == " " + text
        pieces = [x for p in alignment.long_pieces(text, 3) for x in alignment.split_chunks(p)]
        assert pieces == alignment.split_chunks(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 5), max_size=20), st.lists(st.integers(1, 5), max_size=20))
def test_coalescing_and_overlaps(a, b):
    more = sum(a) - sum(b)
    (b if more > 0 else a).extend([abs(more)] * bool(more))
    ae, be = np.cumsum(np.array(a, dtype=np.int64)), np.cumsum(np.array(b, dtype=np.int64))
    starts = ae - np.array(a, dtype=np.int64), be - np.array(b, dtype=np.int64)
    ga, gb = alignment.coalesce(starts[0], ae, starts[1], be)
    cuts = sorted(set(ae.tolist()) & set(be.tolist()))
    assert ga.tolist() == [sum(c < e for c in cuts) for e in ae.tolist()]
    assert gb.tolist() == [sum(c < e for c in cuts) for e in be.tolist()]
    x, y = alignment.overlaps(starts[0], ae, starts[1], be)
    want = [(i, j) for j in range(len(b)) for i in range(len(a)) if starts[0][i] < be[j] and starts[1][j] < ae[i]]
    assert list(zip(x.tolist(), y.tolist(), strict=True)) == want
