import math
import zlib
from collections import Counter

import numpy as np
from brute import WORDS, ascii_lower

from lakestrata.llm import lattice_lm as lm

SCHEMA = "doc_id long, text string"


def segmentations(word, pieces, unknown):
    """All (probability, pieces) of a word with the word-start sign."""
    if not word:
        return [(1.0, [])]
    out = []
    for n in range(1, len(word) + 1):
        head = word[:n]
        if head in pieces:
            out += [(pieces[head] * p, [head, *rest]) for p, rest in segmentations(word[n:], pieces, unknown)]
        elif n == 1:
            out += [(unknown * 256.0 ** -len(head.encode()) * p, ["?", *rest]) for p, rest in segmentations(word[n:], pieces, unknown)]
    return out


def small():
    names = ["", "▁", "▁a", "a", "b", "ab", "▁ab", "ba", "é", "bab"]
    p = np.random.default_rng(1).dirichlet(np.ones(len(names) + 1))
    return names, p, lm.Lattice(names, np.log(p))


def test_forward_sums_all_segmentations():
    names, p, lattice = small()
    words = ["a", "ab", "abab", "babé", "xéy", "aaab", "語", ""]
    got = lattice.word_logps(words)
    for w, logp in zip(words, got, strict=True):
        want = p[0] if w == "" else sum(x for x, _ in segmentations("▁" + w, dict(zip(names, p, strict=False)), p[-1]))
        assert math.isclose(math.exp(logp), want, rel_tol=1e-9)


def test_soft_counts_are_expected_uses():
    names, p, lattice = small()
    words, counts = ["ab", "babé", "", "x"], np.array([3.0, 1.0, 2.0, 1.0])
    got = lattice.soft_counts(words, counts)
    want = Counter()
    for w, c in zip(words, counts, strict=True):
        ways = [(p[0], [""])] if w == "" else segmentations("▁" + w, dict(zip(names, p, strict=False)), p[-1])
        whole = sum(x for x, _ in ways)
        for x, used in ways:
            for piece in used:
                want[piece] += c * x / whole
    for i, name in enumerate([*names, "?"]):
        assert math.isclose(got[i], want[name], abs_tol=1e-9), name


def test_long_words_stay_finite():
    assert np.isfinite(small()[2].word_logps(["ab" * 20_000, "é" * 3_000])).all()


def test_counts_and_base_scores(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).collect()]
    docs += [(None, "the end"), (7001, None), (7002, ""), (7003, " \x0bThe\x1cthe\t"), (7004, "long " * 20_000), docs[0], docs[0]]
    train = Counter()
    for i, t in docs:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            train.update([*WORDS.findall(ascii_lower(t or "")), ""])
    n, v = sum(train.values()), len(train)
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 AS score", "2 AS n_tokens", "'w' AS word")
    got = lm.score_documents(df).collect()
    assert len(got) == len(docs)
    want = Counter()
    for i, t in docs:
        words = [*WORDS.findall(ascii_lower(t or "")), ""]
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        want[(i, i is None or zlib.crc32(str(i).encode()) % 10 == 0, len(words), sum(train[w] > 0 for w in words), n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert len({r.score for r in got if r.doc_id in (7001, 7002)}) == 1


def test_scores_are_sums_of_word_probabilities(spark, monkeypatch):
    docs = [(i, "a b a ab c" if i % 2 else "ab zzz") for i in range(40)]
    got = {r.doc_id: r.score for r in lm.score_documents(spark.createDataFrame(docs, SCHEMA)).collect()}
    monkeypatch.setattr(lm, "HEAVY", 0)  # no word is summed in place
    again = {r.doc_id: r.score for r in lm.score_documents(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got.keys() == again.keys() and all(math.isclose(got[i], again[i], rel_tol=1e-9) for i in got)


def test_empty_table_and_no_training_rows(spark):
    assert lm.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = lm.score_documents(spark.createDataFrame([(held, "some words")], SCHEMA)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and math.isfinite(r.score) and math.isfinite(r.base_score)


def test_nul_is_an_unknown_character():
    names, p, lattice = small()
    words = ["\0", "a\0b", "ab\0", "abab"]
    want = [sum(x for x, _ in segmentations("▁" + w, dict(zip(names, p, strict=False)), p[-1])) for w in words]
    assert np.allclose(np.exp(lattice.word_logps(words)), want, rtol=1e-9, atol=0)
    assert np.isfinite(lattice.soft_counts(words, np.ones(4))).all()


def test_nul_in_training_and_held_out_texts(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    trained = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    rows = [(held, "so\0me words"), (trained, "other wo\0rds \0")]
    got = lm.score_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 2 and all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_score_is_the_lattice_whether_a_word_was_seen_or_not(spark):
    pieces = lm.vocabulary()
    logp = lm.starting_probabilities(pieces)
    words = [("abba", 0, 1), ("zqxj", 500, 500), ("the", 9, 9), ("", 3, 3)]
    got = {r.word: r.lattice for r in lm.with_lattice(spark.createDataFrame(words, "word string, c long, n long"), pieces, logp).collect()}
    again = {r.word: r.lattice for r in lm.with_lattice(spark.createDataFrame([(w, 7 * n, 7 * n) for w, _, n in words], "word string, c long, n long"), pieces, logp).collect()}
    table = dict(zip([p for p, _ in pieces], np.exp(logp), strict=False))
    for w in ("abba", "zqxj", "the"):
        want = sum(x for x, _ in segmentations("▁" + w, table, math.exp(logp[-1])))
        assert math.isclose(got[w], math.log10(want), rel_tol=1e-9) and got[w] == again[w]


def test_fitted_pieces_say_more_of_the_corpus(spark):
    counts = spark.createDataFrame([("the", 50, 50), ("theme", 3, 4), ("zqxj", 2, 2), ("", 5, 5)], "word string, c long, n long")
    pieces = lm.vocabulary()
    total = lambda logp: sum(r.c * r.lattice for r in lm.with_lattice(counts, pieces, logp).collect())
    steps = [total(lm.fit_pieces(counts, pieces, 60, rounds)) for rounds in (0, 1, 2)]
    assert steps[0] < steps[1] < steps[2]


def test_places_without_a_piece_are_looked_up_once():
    class Counted(np.ndarray):
        seen = 0

        def __getitem__(self, at):
            Counted.seen += np.size(at)
            return np.asarray(self).__getitem__(at)

    pieces = [lm.END, *(a + b for a in "abcdefgh" for b in "abcdefgh")]
    lattice = lm.Lattice(pieces, np.full(len(pieces) + 1, -1.0))
    keys = np.append(lattice.keys[1:-2], np.arange(1, 3997, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(-1, 7)
    at = {int(k): i for i, k in enumerate(lattice.keys[1:-2], 1)}
    want = [[at.get(int(k), lattice.none) for k in row] for row in keys]
    lattice.slots = lattice.slots.view(Counted)
    assert lattice._find(keys).tolist() == want
    assert Counted.seen < 1.1 * keys.size


def test_a_slot_that_others_hold_is_passed_over():
    lattice = lm.Lattice([lm.END, "a", "b"], np.full(4, -1.0))
    base = np.uint64(5 << (64 - lattice.SLOT_BITS))
    lattice.keys[1:3] = base + np.uint64(1), base + np.uint64(2)
    lattice.slots[:] = lattice.none
    lattice.slots[5:7] = 1, 2
    keys = np.array([[base + np.uint64(2), base + np.uint64(1), base + np.uint64(3)]], dtype=np.uint64)
    assert lattice._find(keys).tolist() == [[2, 1, lattice.none]]


def test_batches_are_joined_whole_and_in_order():
    import pyarrow as pa

    parts = [pa.RecordBatch.from_arrays([pa.array(range(a, a + 25_000))], names=["x"]) for a in range(0, 200_000, 25_000)]
    out = list(lm.joined(iter(parts)))
    assert [x.num_rows for x in out] == [75_000, 75_000, 50_000] and list(lm.joined(iter([]))) == []
    assert [x for t in out for x in t["x"].to_pylist()] == list(range(200_000))
