import importlib
import sys
from collections import Counter

import pytest
from brute import near_duplicates
from test_mixing import brute as brute_mix
from test_packing import check

import corpus_pipeline
from lakestrata.llm import language_id, toxicity

SF = "/root/testdata/sf0.001"


def key(r):
    return r.doc_id, r.text, r.lang, r.source, r.n_chars


def test_stages_match_brute_force(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    held = [key(r) for r in docs.collect()]
    frame = lambda: spark.createDataFrame(held, docs.schema)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = frame()
        if name == "toxicity":
            toxic = {r.doc_id for r in toxicity.classify(df, labels).collect() if r.predicted}
            want = Counter(x for x in held if x[0] not in toxic)
            assert toxic
        elif name == "language_id":
            bad = {r.doc_id for r in language_id.identify(df).collect() if r.lang_pred == "und" or r.score < 1 / 3}
            want = Counter(x for x in held if x[0] not in bad)
        elif name == "minhash_dedup":
            parts = near_duplicates([x[:2] for x in held], 5, 80)
            want = Counter(x for x in held if parts[x[0]][1] == x[0])
            assert len(want) < len(held)
        elif name == "mix_sources":
            by_id = {x[0]: x for x in held}
            want = Counter()
            for (doc, *_), n in brute_mix(held).items():
                want[by_id[doc]] += n
        out = stage(spark, df, SF)
        if name == "pack":
            check(out.collect(), [x[:2] for x in held], 4096)
        else:
            assert out.columns == columns, name
            held = [key(r) for r in out.collect()]
            assert Counter(held) == want, name
    assert k == 4


def test_run_is_the_composition(spark):
    out = corpus_pipeline.run(spark, SF)
    tokens = out.groupBy("sequence_id").sum("length").collect()
    assert tokens and max(r[1] for r in tokens) <= 4096


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == []
        docs = out if out.columns == docs.columns else docs


def test_clashing_columns_survive(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    extra = docs.selectExpr("*", "'e' AS score", "'e' AS predicted", "'e' AS kept", "'e' AS component_id", "'e' AS copy_no", "'e' AS lang_pred", "'e' AS id", "'e' AS __lang", "'e' AS __share", "'e' AS __toxic", "'e' AS __order", "'e' AS __n", "'e' AS __source", "'e' AS doc")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, SF)
        assert out.columns == extra.columns and all(r.score == r.copy_no == r["__lang"] == r["__toxic"] == r["__order"] == r.doc == "e" for r in out.collect())


@pytest.mark.parametrize("gone", ["corpus_pipeline", "lakestrata.llm"])
def test_entry_works_without_these_folders(monkeypatch, gone):
    for name in [m for m in sys.modules if m == gone or m.startswith(f"{gone}.")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, gone, None)
    if gone == "lakestrata.llm":
        monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    entry = importlib.reload(importlib.import_module("__spark_entry__"))
    assert "gold_customer_360" in entry.queries() and not any(q.startswith("op") for q in entry.queries())
    assert "gold_customer_360" in entry.oracle_sql()


def test_entry_has_all_queries():
    entry = importlib.reload(importlib.import_module("__spark_entry__"))
    names = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)) and "pipeline" in names
    assert "op1_mix_sources" in entry.oracle_sql()
