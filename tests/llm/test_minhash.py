import random

import numpy as np
import pytest
from brute import near_duplicates, shingles

from lakestrata.llm import minhash_dedup as md

SCHEMA = "doc_id long, text string"


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 80)))) for i in range(60)]
    base = [word() for _ in range(120)]
    for i in range(100, 180):  # near copies around the threshold, some only linked through others
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(len(text))] = word()
        rows.append((i, " ".join(text)))
    for i in range(200, 230):  # a chain: each a little further from the first
        base = list(base)
        base[rng.randrange(len(base))] = word()
        rows.append((i, " ".join(base)))
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "ONE"), (305, "one two"), (306, "\x0bone\x0ctwo"), (307, "x " * 30_000), (308, "É é"), (309, "é É")]
    return rows + [rows[3], rows[3]]


@pytest.mark.parametrize(("width", "per_cent"), [(3, 85), (5, 80)])
def test_same_as_brute_force(spark, width, per_cent):
    rows = corpus()
    want = near_duplicates(rows, width, per_cent)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "7 AS n_shingles", "8 AS component_id", "9 AS id", "'s' AS set_key")
    got = md.near_duplicates(df, width, per_cent).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({c for _, c in want.values()}) < len(want)


def test_strays_are_met_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(md, "BLOCK", 4)
    rows = corpus(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in md.near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 85).collect()}
    assert got == near_duplicates(rows, 3, 85)


def test_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (None, None), (2, "A B C d e f")]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in md.near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 85).collect())
    assert got == [("2", 4, 2, True), ("4", 4, 2, False), ("None", 0, None, True), ("None", 4, None, True)]
    assert md.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_keep_representatives(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS kept", "2 AS n", "3 AS id")
    kept = md.keep_representatives(df)
    assert kept.columns == df.columns
    want = {i for i, (_, c) in near_duplicates(rows, 5, 80).items() if i == c}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert md.keep_representatives(df.limit(0)).collect() == []


def test_shingle_sets_match_word_tuples():
    texts = [t or "" for _, t in corpus()]
    for width in (3, 5):
        for t, got in zip(texts, md.shingle_sets([t.encode() for t in texts], width), strict=True):
            assert len(got) == len(shingles(t, width))


def test_least_matches_are_posterior_quantiles():
    for n, m in zip(range(md.BATCH, md.HASHES + 1, md.BATCH), md.least_matches(0.85), strict=True):
        draws = np.random.default_rng(0).beta(m + 1, n - m + 1, 400_000)
        less = np.random.default_rng(0).beta(m, n - m + 2, 400_000)
        assert (draws >= 0.85).mean() > md.MISS / 3 and (less >= 0.85).mean() < md.MISS * 3


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.81, 0.85, 0.95])
def test_pairs_at_the_threshold_are_lost_in_at_most_1_of_10000_cases(threshold):
    bands, rows = md.banding(threshold)
    assert bands * rows <= md.HASHES
    assert (1 - threshold**rows) ** bands + md.look_loss(threshold, md.Verifier(None, None, 5, round(threshold * 100)).needed) <= 1e-4


def test_look_loss_is_the_share_of_dropped_pairs():
    rng, needed = np.random.default_rng(0), [18, 37, 56, 75, 94]
    equal = (rng.random((40_000, md.HASHES)) < 0.8).astype("<u4")
    kept, _ = md.surviving(equal, np.ones_like(equal), needed)
    assert abs(1 - len(kept) / len(equal) - md.look_loss(0.8, needed)) < 0.01


def test_thresholds_too_low_for_the_hashes_are_refused():
    with pytest.raises(ValueError, match="too few"):
        md.banding(0.01)
