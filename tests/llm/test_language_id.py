import itertools
import random
import zlib

import numpy as np
import pytest

from lakestrata.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string"


def rows(n=400):
    rng = random.Random(2)
    parts = {"aa": ["the", "ing", "tion", "wh", "ou"], "bb": ["ß", "sch", "ung", "keit", "ä"], "cc": ["é", "eau", "oi", "ç", "eux"]}
    out = []
    for i in range(n):
        lang = ["aa", "aa", "bb", "cc"][i % 4]
        out.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 60))), lang))
    return out


def test_held_out_accuracy(spark):
    docs = rows()
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "'x' AS lang_pred", "1 AS score", "2 AS __order")
    got = li.identify(df).collect()
    truth = {i: lang for i, _, lang in docs}
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out]) > 0.97


def test_odd_texts(spark):
    docs = rows(200) + [(None, "the thing", "bb"), (901, None, "aa"), (902, "", "aa"), (903, "12 % 😀 \x00", None), (904, "the " * 30_000, None), (905, "a" * 30_000, None), (906, "語", None)]
    got = {r.doc_id: r for r in li.identify(spark.createDataFrame(docs + [docs[0]] * 2, SCHEMA)).collect()}
    assert {i: (got[i].lang_pred, got[i].score) for i in (901, 902, 903)} == {i: ("und", 0.0) for i in (901, 902, 903)}
    assert got[904].lang_pred == "aa" and got[905].lang_pred != "und" and got[906].lang_pred != "und"


def test_empty_and_unlabelled_tables(spark):
    assert li.identify(spark.createDataFrame([], SCHEMA)).collect() == []
    got = li.identify(spark.createDataFrame([(1, "word", None)], SCHEMA)).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)


def test_switching_text_stays_in_the_pipeline(spark):
    docs = rows(200) + [(900, "thing thetion which ouing " * 5 + "schung keitä ungsch ßkeit " * 5, "aa"), (901, "!!! 12", "aa")]
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 AS score")
    kept = li.drop_undetermined(df)
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 900 in ids and 901 not in ids and len(ids) == 201


@pytest.mark.parametrize("chunk", [1, 2, 64])
def test_marginals_match_enumeration(monkeypatch, chunk):
    monkeypatch.setattr(li, "CHUNK", chunk)
    rng = np.random.default_rng(0)
    crf = li.Crf(["a", "b", "c"])
    crf.t = rng.normal(size=(3, 3))
    lengths = [4, 0, 1, 5, 3]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    e = np.exp(rng.normal(size=(sum(lengths), 3)))
    got = crf.marginals(e, offsets)
    for a, b in itertools.pairwise(offsets):
        total = np.zeros((b - a, 3))
        for labels in itertools.product(range(3), repeat=int(b - a)):
            p = np.prod([e[a + i, y] for i, y in enumerate(labels)]) * np.exp(sum(crf.t[x, y] for x, y in itertools.pairwise(labels)))
            for i, y in enumerate(labels):
                total[i, y] += p
        if b > a:
            assert np.allclose(got[a:b], total / total.sum(axis=1, keepdims=True))


def test_words_and_features_of_one_text_do_not_depend_on_others():
    texts = ["Ab cd", "", "x", "éa 12 bé", "\x00a", "a😀b"]
    flat, offsets = li.words(texts)
    assert np.diff(offsets).tolist() == [2, 0, 1, 2, 1, 2]
    found, owner = li.features(flat)
    for i, t in enumerate(texts):
        own_found, own_owner = li.features(li.words([t])[0])
        mine = [sorted(found[owner == w].tolist()) for w in range(offsets[i], offsets[i + 1])]
        assert mine == [sorted(own_found[own_owner == w].tolist()) for w in range(offsets[i + 1] - offsets[i])]


def test_sample_is_limited_before_the_shuffle(spark):
    keys = spark.range(5000).selectExpr("id AS doc_id", "concat('a', id % 2) AS lang")
    plan = li.first_by_hash(keys, li.SAMPLE_ROWS, "lang")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    with pytest.raises(ValueError, match="1,000"):
        li.first_by_hash(keys, 1001, "lang")


def test_sample_is_the_first_of_each_group_whatever_its_size(spark):
    keys = spark.range(30_000).selectExpr("id DIV 2 AS doc_id", "if(id % 200 < 2, 'rare', 'hot') AS lang")  # every id twice
    found = li.first_by_hash(keys, 200, "lang")
    want = keys.distinct().selectExpr("*", "row_number() over (partition by lang order by xxhash64(11, doc_id), doc_id) AS r").filter("r <= 200")
    assert {(r.doc_id, r.lang) for r in found.collect()} == {(r.doc_id, r.lang) for r in want.collect()}
    assert {r["lang"]: r["count"] for r in found.groupBy("lang").count().collect()} == {"hot": 200, "rare": 150}
