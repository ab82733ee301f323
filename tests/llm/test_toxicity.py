import math
import random
import zlib

import numpy as np

from lakestrata.llm import toxicity as tx

SCHEMA, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def rows(n=1200):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["idiot,", "Scum", "moron!"])
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_columns(spark):
    docs, labels = rows()
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "0.9 AS score", "'x' AS predicted", "1 AS toxic", "2 AS __order")
    got = tx.classify(df, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(docs)
    truth = {i: t for i, _, t in labels}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_nulls_repeats_and_labels_do_not_leak(spark):
    docs, labels = rows(400)
    docs += [(None, "idiot"), (9001, None), (9002, ""), (9003, "idiot " * 30_000)] + [docs[0]] * 3
    labels += [(None, 1, 1), (5, 1, None), (5, 0, 0), (99_999, 1, 1)] + [labels[0]] * 2
    out = tx.classify(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(docs)
    empty = {r.score for r in out if r.doc_id in (9001, 9002)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert len({r.score for r in out if r.doc_id == docs[0][0]}) == 1
    # labels of held-out rows change nothing
    flipped = [(i, q, 1 - t if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    again = tx.classify(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(flipped, LABELS)).collect()
    assert sorted((str(r.doc_id), r.score) for r in out) == sorted((str(r.doc_id), r.score) for r in again)


def test_empty_tables(spark):
    none, unlabelled = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert tx.classify(none, unlabelled).collect() == []
    got = tx.classify(spark.createDataFrame([(1, "a")], SCHEMA), unlabelled).first()
    assert math.isclose(got.score, 1 / 3) and got.predicted == 0


def test_features_are_ngrams_and_skipgrams():
    one, _ = tx.distinct(*tx.features([b"a b c d"]))
    assert len(one) == 4 + 3 + 2 + 1  # words, pairs, one left out, two left out
    two, owner = tx.features([b"a b", b"c"])
    assert owner.tolist().count(0) == 3 and owner.tolist().count(1) == 1 and len(two) == 4


def test_updates_follow_the_rule():
    model = tx.Ftrl(8)
    at = np.array([1, 3])
    for label in (1, 0, 1, 1):
        z, n, w = model.z[at].copy(), model.n[at].copy(), model.weights(at)
        g = 1 / (1 + math.exp(-(model.bias + w.sum()))) - label
        model.learn(at, label)
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / tx.ALPHA
        assert np.allclose(model.z[at], z + g - sigma * w) and np.allclose(model.n[at], n + g * g)
    assert (model.weights(np.array([0, 2])) == 0).all()


def test_drop_toxic_keeps_columns(spark):
    docs, labels = rows(600)
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 AS score", "'k' AS __label")
    kept = tx.drop_toxic(df, spark.createDataFrame(labels, LABELS))
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    clean = {i for i, _, t in labels if t == 0}
    assert len(clean - ids) <= 0.02 * len(clean) and len(ids - clean) <= 0.05 * len(docs)
