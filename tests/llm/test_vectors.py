import numpy as np
import pytest
from brute import components

from lakestrata.llm import ann_mih, hnsw_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n=600, d=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for i in range(0, n, 7):  # near copies
        x[i] = x[(i * 3) % n] + rng.normal(size=d) * 0.08
    x = x.astype(np.float32)
    return [(i, [float(v) for v in x[i]], i % 3) for i in range(n)]


ODD = [
    (9000, None, 0), (9001, [0.0] * 16, 0), (9002, [float("nan")] * 16, 0), (9003, [float("inf")] + [0.0] * 15, 0), (9004, [None] + [1.0] * 15, 0),
    (9005, [1.0, 2.0], 0), (None, [1.0] * 16, 0),
]


def brute_search(rows, queries, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows])
    out = {}
    for q, v, _ in queries:
        s = x @ np.array(v)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_search_recall_and_exact_scores(spark):
    rows = vectors()
    df = spark.createDataFrame(rows + ODD, SCHEMA).selectExpr("*", "1 AS rank", "2 AS score", "3 AS block", "4 AS query_id")
    got = {}
    for r in ann_mih.search(df, df.filter("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_search(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        scores = {v: float(np.dot(np.array(rows[v][1]), np.array(rows[q][1]))) for _, v, _ in found}
        assert all(abs(scores[v] - s) < 1e-9 for _, v, s in found)
        hits += len({v for _, v, _ in found} & {v for v, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)


def test_search_ties_repeats_and_few_candidates(spark):
    rows = [(i, [1.0, 0.0], 0) for i in (5, 3, 3, 9, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [(r.query_id, r.rank, r.vec_id) for r in ann_mih.search(df, df.filter("vec_id = 0"), 20).orderBy("rank").collect()]
    assert got == [(0, 1, 3), (0, 2, 5), (0, 3, 9)]
    empty = df.limit(0)
    assert ann_mih.search(empty, empty).collect() == []
    assert ann_mih.search(df, empty).collect() == []


@pytest.mark.parametrize("radius", [0, 5, 40, 63, 110])
def test_multi_index_finds_every_code_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 1 << 16, size=(500, ann_mih.TABLES), dtype=np.uint16)
    codes[::3] = codes[0] ^ (rng.random((167, ann_mih.TABLES)) < 0.2).astype(np.uint16)
    index = ann_mih.MultiIndex(codes)
    for q in codes[:20]:
        assert index.within(q, radius).tolist() == np.flatnonzero(ann_mih.hamming(codes, q) <= radius).tolist()


def brute_links(rows, threshold):
    good = [(i, np.array(v, dtype=float), label) for i, v, label in rows if i is not None and label is not None and v is not None and None not in v and len(v) == 16 and np.isfinite(np.array(v, float)).all() and np.any(v)]
    unit = np.array([v / np.linalg.norm(v) for _, v, _ in good])
    close = unit @ unit.T >= threshold
    labels = np.array([label for _, _, label in good])
    close &= labels[:, None] == labels[None, :]
    np.fill_diagonal(close, False)
    links = [(good[a][0], good[b][0]) for a, b in zip(*np.nonzero(close), strict=True)]
    return {good[a][0]: int(n) for a, n in enumerate(close.sum(axis=1))}, links


@pytest.mark.parametrize("shard", [6144, 60])
def test_near_duplicates_match_brute_force(spark, shard):
    rows = vectors(500, seed=4)
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(40)] + [(2000, rows[5][1], 99), (2001, rows[6][1], None)] + [x for x in ODD if x[0]]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n_links", "2 AS component_id", "3 AS id", "4 AS copies")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw_dedup.near_duplicates(df, 0.93, shard).collect()}
    counts, links = brute_links(rows, 0.93)
    parts = components([r[0] for r in rows], links)
    assert got == {i: (counts.get(i, 0), parts[i], i == parts[i]) for i in parts}
    assert len(links) > 1500


def test_near_duplicates_of_empty_and_odd_tables(spark):
    assert hnsw_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [*ODD, (1, [1.0] * 16, None)]
    got = hnsw_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and all(r.n_links == 0 and r.kept and r.component_id == r.vec_id for r in got)


def test_beam_search_finds_neighbours():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw_dedup.Graph.build(x, hnsw_dedup.mix64(np.arange(1500).astype(np.uint64)))
    assert len(graph.layers) > 1
    ids, _ = graph.search(x[:200], 64)
    best = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, best, strict=True)]) > 0.95


def unit_vectors(n, d, seed):
    x = np.random.default_rng(seed).normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_to(x, noise, seed):
    y = x + noise * np.random.default_rng(seed).normal(size=x.shape) / np.sqrt(x.shape[-1])
    return y / np.linalg.norm(y, axis=-1, keepdims=True)


def built(x):
    return hnsw_dedup.Graph.build(x.astype(np.float32), hnsw_dedup.mix64(np.arange(len(x)).astype(np.uint64)))


def test_few_links_are_found_where_the_graph_loses_them():
    a = unit_vectors(2000, 32, 1)
    b = unit_vectors(1500, 32, 2)
    b[700:710] = near_to(a[:10], 0.1, 3)  # 10 linked queries: most samples hold none
    graph = built(a)
    graph.layers = [np.full_like(layer, len(a)) for layer in graph.layers]  # no vertex is joined to another
    links = hnsw_dedup.find_links(graph, a, b, 0.93)
    assert links.sum() == 10 and links[np.arange(700, 710), np.arange(10)].all()


def test_groups_that_the_graph_cuts_off_are_found():
    x = unit_vectors(3000, 32, 4)
    x[1:2000:2] = near_to(x[:2000:2], 0.1, 5)
    x[2900:2960] = near_to(np.repeat(x[2900:2901], 60, axis=0), 0.1, 6)
    graph, group = built(x), np.arange(2900, 2960)
    for layer in graph.layers:  # links from outside into the group go
        others = np.setdiff1d(np.arange(len(layer)), group)
        layer[others] = np.where(np.isin(layer[others], group), len(x), layer[others])
    assert set(group) <= set(graph.unreached()) or graph.top[group].max() == graph.top.max()
    links = hnsw_dedup.find_links(graph, x, x, 0.93)
    want = x @ x.T >= 0.93
    assert (links[group] == want[group]).all() and (links & want).sum() >= 0.99 * want.sum() and not (links & ~want).any()


def test_own_vertices_are_no_evidence_of_recall():
    x = unit_vectors(2000, 32, 7)
    x[1:1200:2] = near_to(x[:1200:2], 0.1, 8)
    graph = built(x)
    lowest = graph.layers[0]
    for i in range(1200):  # the links of each pair go
        lowest[i][lowest[i] == i ^ 1] = len(x)
    links = hnsw_dedup.find_links(graph, x, x, 0.93)
    assert (links & (x @ x.T >= 0.93)).sum() >= 0.98 * (x @ x.T >= 0.93).sum()


def test_several_shards_of_a_label_match_brute_force(spark):
    x = unit_vectors(1800, 32, 9)
    x[:40] = near_to(x[1000:1040], 0.1, 10)  # few pairs
    x[300:360] = near_to(np.repeat(x[300:301], 60, axis=0), 0.1, 11)  # a tight group
    rows = [(i, [float(c) for c in v.astype(np.float32)], 0) for i, v in enumerate(x)]
    x = np.array([v for _, v, _ in rows])
    close = x @ x.T >= 0.93 * np.linalg.norm(x, axis=1) * np.linalg.norm(x, axis=1)[:, None]
    np.fill_diagonal(close, False)
    parts = components(list(range(len(x))), [(int(a), int(b)) for a, b in zip(*np.nonzero(close), strict=True)])
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), 0.93, 700).collect()}
    assert got == {i: (int(close[i].sum()), parts[i]) for i in parts}


@pytest.mark.parametrize("itself", [True, False])
def test_rare_links_come_through_the_graph(monkeypatch, itself):
    a = unit_vectors(4000, 24, 12)
    b = a if itself else unit_vectors(3000, 24, 13)
    places = np.arange(700, 712)
    b[places] = near_to(a[:12], 0.1, 14)  # 12 linked pairs: most samples hold none
    scanned = []
    whole = hnsw_dedup.scan
    monkeypatch.setattr(hnsw_dedup, "scan", lambda exact, asked, threshold: scanned.append(len(asked)) or whole(exact, asked, threshold))
    places, probes = hnsw_dedup.audit(a, b, 0.93)
    assert len(places) == hnsw_dedup.AUDIT_PROBES  # each has a link: the audit is never empty
    assert np.allclose((probes * a[places]).sum(axis=1), 0.93) and np.allclose(np.linalg.norm(probes, axis=1), 1)
    links = hnsw_dedup.find_links(built(a), a, b, 0.93)
    want = b @ a.T >= 0.93
    if itself:
        np.fill_diagonal(want, False)
        np.fill_diagonal(links, False)
    assert not scanned and want.sum() >= 12 and (links == want).all()


def test_audit_widens_until_links_at_the_threshold_are_found():
    x = unit_vectors(4000, 24, 16)
    graph = built(x)
    assert hnsw_dedup.audited_width(graph, x, hnsw_dedup.audit(x, x, 0.93)[1], 0.93) == hnsw_dedup.BEAM
    for layer in graph.layers:  # most links go
        layer[:, 2:] = len(x)
    width = hnsw_dedup.audited_width(graph, x, hnsw_dedup.audit(x, x, 0.93)[1], 0.93)
    assert width > hnsw_dedup.BEAM
    alike = np.repeat(x[:1], 40, axis=0)  # a query along a vertex turns it nowhere
    assert np.allclose(hnsw_dedup.audit(alike, alike, 0.93)[1], alike)


def two_lengths(n=300):
    rng = np.random.default_rng(15)
    rows = []
    for i in range(n):
        d = 8 if i % 3 == 0 else 16
        v = rng.normal(size=d) if i < 30 else np.array(rows[i % 30 if i % 30 % 3 == i % 3 else i - 3][1]) + rng.normal(size=d) * 0.05
        rows.append((i, [float(np.float32(x)) for x in v], i % 2))
    return rows


def test_two_lengths_of_vectors(spark):
    rows = two_lengths()
    df = spark.createDataFrame(rows, SCHEMA)
    counts, links = {}, []
    for d in (8, 16):
        mine = [r for r in rows if len(r[1]) == d]
        unit = np.array([r[1] for r in mine]) / np.linalg.norm([r[1] for r in mine], axis=1, keepdims=True)
        close = (unit @ unit.T >= 0.93) & (np.array([r[2] for r in mine])[:, None] == np.array([r[2] for r in mine])[None, :])
        np.fill_diagonal(close, False)
        counts |= {mine[a][0]: int(x) for a, x in enumerate(close.sum(axis=1))}
        links += [(mine[a][0], mine[b][0]) for a, b in zip(*np.nonzero(close), strict=True)]
    parts = components([r[0] for r in rows], links)
    assert min(sum(n > 0 for i, n in counts.items() if (i % 3 == 0) is short) for short in (True, False)) > 20
    assert {r.vec_id: (r.n_links, r.component_id) for r in hnsw_dedup.near_duplicates(df).collect()} == {i: (counts[i], parts[i]) for i in parts}

    asked = [r for r in rows if r[0] % 20 == 0]
    got = {}
    for r in ann_mih.search(df, spark.createDataFrame(asked, SCHEMA), 5).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in asked:
        mine = [r for r in rows if len(r[1]) == len(q[1])]
        want = {v for v, _ in brute_search(mine, [q], 5)[q[0]]}
        hits, total = hits + len(got[q[0]] & want), total + len(want)
    assert hits >= 0.9 * total


def test_queries_of_a_length_that_no_vector_has(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)], 0) for i in range(5)], SCHEMA)
    asked = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 0)], SCHEMA)
    assert ann_mih.search(df, asked).collect() == []
