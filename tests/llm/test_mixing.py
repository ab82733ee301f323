import hashlib
import math
from collections import Counter

from lakestrata.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, weights=None, epochs=1.0, seed=17):
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1] or "") + 1
    weight = {s: (n**0.5 if weights is None else weights.get(s, 0)) for s, n in size.items()}
    weight = {s: w for s, w in weight.items() if w > 0}
    total = sum(size[s] for s in weight)
    out = Counter()
    for r in rows:
        if r[3] not in weight:
            continue
        mean = epochs * total * weight[r[3]] / sum(weight.values()) / size[r[3]]
        key = f"{seed}:{'-' if r[0] is None else r[0]}:{'-' if r[3] is None else r[3]}"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 16**13
        k, p, below = 0, math.exp(-mean), math.exp(-mean)
        while below <= u:
            k += 1
            p *= mean / k
            below += p
        out.update((r[0], r[1], r[3], c) for c in range(1, k + 1))
    return out


def table(spark):
    rows = [(i if i % 17 else None, "w" * (i % 40) if i % 11 else None, "en", [None, "a", "b", "hot", "hot", "hot"][i % 6], 0) for i in range(400)]
    return rows + [(5, "same", "en", "hot", 0)] * 3, spark


def copies(df):
    return Counter((r.doc_id, r.text, r.source, r.copy_no) for r in df.collect())


def test_same_as_brute_force(spark):
    rows, _ = table(spark)
    assert copies(mixing.mix_sources(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_given_weights_and_epochs(spark):
    rows, _ = table(spark)
    weights = {"a": 1.0, None: 3.0, "b": 0.0}
    got = copies(mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), weights=weights, epochs=4.0))
    assert got == brute(rows, weights, 4.0)
    assert {k[2] for k in got} == {"a", None}


def test_large_means_do_not_underflow(spark):
    rows = [(i, "x", "en", "a", 0) for i in range(3)]
    got = copies(mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), epochs=2000.0))
    n = Counter(k[0] for k in got)
    assert set(n) == {0, 1, 2} and all(1700 < v < 2300 for v in n.values())


def test_clashing_columns_and_empty_table(spark):
    rows, _ = table(spark)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' AS Copy_No", "'mine' AS mean_rate")
    out = mixing.mix_sources(df)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy_no", "mean_rate", "shuffle_key"]
    assert copies(out) == brute(rows)
    plain = mixing.mix_sources(df, annotate=False)
    assert plain.columns == df.columns and {r.mean_rate for r in plain.collect()} == {"mine"}
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []


def test_native_plan(spark):
    rows, _ = table(spark)
    plan = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_columns_named_like_inner_ones_come_back_unchanged(spark):
    rows, _ = table(spark)
    names = ("__order", "__n", "__key", "__u", "__source", "doc", "cdf", "key", "n", "u", "size", "weight", "copy_no", "Shuffle_Key")
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *(f"concat('{x}', doc_id) AS `{x}`" for x in names))
    out = mixing.mix_sources(df, annotate=False)
    assert out.columns == df.columns
    assert Counter((r.doc_id, r.text, r.source) for r in out.collect()) == Counter(k[:3] for k, n in brute(rows).items() for _ in range(n))
    assert all(r[x] is None if r.doc_id is None else r[x] == f"{x}{r.doc_id}" for r in out.collect() for x in names)
