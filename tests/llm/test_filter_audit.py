import itertools
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestrata.llm import csr, filter_audit

SCHEMA = "doc_id long, text string, lang string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i}" for i in range(250))


def brute(rows, labels):
    good = {d for d, q, t in labels if q == 1}
    toxic = {d for d, q, t in labels if t == 1}
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    docs = []
    for d, t, lang in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": d is not None and d > least[t],
        }
        docs.append((lang or "", {x for x, v in fails.items() if v}, d in good and d is not None, d in toxic and d is not None))
    out = {}
    for part in {x[0] for x in docs}:
        mine = [x for x in docs if x[0] == part]
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, x in enumerate(order, 1):
                hit = [y for y in left if x in y[1]]
                left = [y for y in left if x not in y[1]]
                shapley[x] += len(hit)
                redundant = sum(x in y[1] and bool(y[1] & set(order[: step - 1])) for y in mine)
                out[part, order, step] = [len(left), len(hit), redundant, sum(y[1] == {x} for y in mine), sum(y[2] for y in hit), sum(y[3] for y in hit)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def run(spark, rows, labels, **more):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS failed", "2 AS part", "3 AS n", "4 AS __key")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text", "1 AS __key")
    got = filter_audit.filter_interactions(df, marks, **more).collect()
    return {(r.part, r.filter_order, r.step): list(r)[3:] for r in got}


ROWS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, None), (3, LONG, ""), (None, LONG, "en"), (None, LONG + " $", "en"),
    (4, None, "de"), (5, "", "de"), (6, " \t\n\x0b\x0c\r ", "de"), (7, "a\x1cb\x85c\xa0 d", "de"), (8, "AB cd", "fr"), (9, "a b " * 150, "fr"),
    (10, "É #" + " x" * 300, "fr"), (11, LONG.upper(), "fr"), (12, LONG.upper(), "en"), (1, LONG, "en"), (13, "z" * 70000, "en"), (14, LONG + " end", "en"), (2**60, LONG, "de"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, None), (3, None, 1), (12, 1, 1), (14, 1, 0), (99, 1, 1), (None, 1, 1)]


def test_equals_brute_force(spark):
    want = brute(ROWS, LABELS)
    assert run(spark, ROWS, LABELS) == want
    assert run(spark, ROWS * 2, LABELS, shard_bytes=500) == brute(ROWS * 2, LABELS)


def test_every_order_of_a_part_adds_up(spark):
    got = run(spark, ROWS, LABELS)
    for part in ("", "en", "de", "fr"):
        n = sum((x[2] or "") == part for x in ROWS)
        for order in filter_audit.ORDERS:
            steps = [got[part, order, k] for k in range(1, 6)]
            assert sum(x[1] for x in steps) + steps[-1][0] == n
    assert len(got) == 4 * 600


def test_matrix_is_globally_encoded(spark):
    rows = [(1, "a b a", "en"), (2, "b  c", "en"), (3, None, "en"), (4, "c c c a", "en")] * 3
    shards = filter_audit.local_shards(spark.createDataFrame(rows, SCHEMA), shard_bytes=8).cache()
    assert shards.count() > 3
    words = filter_audit.global_dictionary(shards)
    ids = {r.word: r.word_id for r in words.filter("occurrence = word_id").collect()}
    assert len(ids) == len(set(ids.values())) == 3
    assert all(ids[r.word] == r.word_id for r in words.collect())
    found = []
    for r in filter_audit.document_terms(spark.createDataFrame(rows, SCHEMA), shard_bytes=8).collect():
        assert len(r.indptr) == len(r.doc_id) + 1
        found += [(d, sorted(r.data[a:b])) for d, a, b in zip(r.doc_id, r.indptr[:-1], r.indptr[1:], strict=True)]
    assert sorted(found) == sorted([(1, [1, 2]), (2, [1, 1]), (3, []), (4, [1, 3])] * 3)


def test_empty_tables(spark):
    assert run(spark, [], LABELS) == {}
    assert run(spark, ROWS[:3], []) == brute(ROWS[:3], [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 7)), max_size=60))
def test_count_matrix(cells):
    cells = sorted(cells)
    rows, columns = (np.array([x[k] for x in cells], dtype=np.int64) for k in (0, 1))
    indptr, indices, data = csr.count_matrix(rows, columns, 6, 8)
    want = Counter(cells)
    got = {(r, int(c)): int(n) for r in range(6) for c, n in zip(indices[indptr[r] : indptr[r + 1]], data[indptr[r] : indptr[r + 1]], strict=True)}
    assert got == want
    for x, y in zip(csr.unpack(csr.pack(indptr, indices, data)), (indptr, indices, data), strict=True):
        assert x.tolist() == y.tolist()
    assert csr.row_sums(indptr, data).tolist() == [sum(x[0] == r for x in cells) for r in range(6)]
