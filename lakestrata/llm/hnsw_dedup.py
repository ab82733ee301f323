"""Embedding near-duplicates by hierarchical navigable small-world graphs.

Vectors of one label are dealt by hash into shards of bounded size, and each
shard gets a graph: layers of ever fewer vectors, in which every vector is
linked to near ones of its layer.  Vectors are inserted in batches of doubling
size; a batch searches the graph so far and itself.  Every vector queries every
shard of its label: greedily down to the lowest layer, then with a beam that is
as wide as it must be.  An audit turns a bounded sample of ``AUDIT_PROBES``
vertices towards queries until they are as far off as a link may be, compares
these probes with the whole shard, and beams are widened until they hold
``RECALL`` of the probes' links: every probe has one, so that the audit is never
empty, however rare links are, and it judges the hardest links.  A beam full of
links is widened further for its query; the widest beam, and the last step of
both, is the whole shard.  Vertices that no path joins to the entry are compared
with every query.

Links are verified by cosine in double precision.  A pair of shards meets in one
task, which queries both graphs and keeps a link that either side found, so
that links are mutual.  Tasks return the number of links of each vector and a
spanning forest of them, never the pairs; forests are joined into components.

Equal vectors of a label are one vertex with as many copies.  Vectors of one
label that differ in length don't meet.  Shards pair up
within a label, so work on a label grows with the square of its shards, as
querying every shard does; tasks stay bounded.

Defined cases: rows with null label or id, or without a usable vector (see
``vectors.usable``), link with nothing; they are components of their own; a row
without an id has a null component and is kept; rows that repeat an id and a
vector are copies that link with each other; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import materialize, mix64
from lakestrata.llm.components import connected_components
from lakestrata.llm.vectors import matrix, usable

SHARD = 6144
LINKS = 16  # of a vertex in an upper layer; twice that in the lowest
BUILD_BEAM = 64
BEAM, WIDEN = 32, 4
EXPAND = 4  # vertices of each beam that are expanded in one step
BATCH = 512
AUDIT_PROBES = 512
RECALL = 0.995
SLACK = 1e-4  # the graph's cosines are single precision


def beam_search(x: np.ndarray, links: np.ndarray, asked: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best vertices found for each query, best first, with their
    cosines (-1 and -inf where fewer were found), from the entries of each."""
    n, rows = len(x), np.arange(len(asked))
    seen = np.zeros((len(asked), n + 1), dtype=bool)
    seen[:, n] = True  # the place of missing links
    ids = np.full((len(asked), width), n)
    sims = np.full((len(asked), width), -np.inf, dtype=x.dtype)
    done = np.ones((len(asked), width), dtype=bool)
    fresh = entry
    while True:
        # meet the fresh vertices: each once
        fresh = np.where(seen[rows[:, None], fresh], n, fresh)
        fresh = np.sort(fresh, axis=1)
        fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = n
        seen[rows[:, None], fresh] = True
        got = np.einsum("bmd,bd->bm", x[np.minimum(fresh, n - 1)], asked[rows])
        got[fresh == n] = -np.inf
        all_ids, all_sims = np.concatenate([ids[rows], fresh], axis=1), np.concatenate([sims[rows], got], axis=1)
        all_done = np.concatenate([done[rows], fresh == n], axis=1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
        ids[rows], sims[rows] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_sims, order, 1)
        done[rows] = np.take_along_axis(all_done, order, 1)
        # expand the best vertices of each beam that have not been
        rows = rows[~done[rows].all(axis=1)]
        if not len(rows):
            break
        place = np.argsort(done[rows], axis=1, kind="stable")[:, :EXPAND]
        taken = np.where(np.take_along_axis(done[rows], place, 1), n, np.take_along_axis(ids[rows], place, 1))
        marked = done[rows]
        np.put_along_axis(marked, place, True, 1)
        done[rows] = marked
        fresh = links[taken].reshape(len(rows), -1)
    ids[sims == -np.inf] = -1
    return ids, sims


class Graph:
    """The layers of one shard; vertices are places in ``x`` (unit vectors)."""

    def __init__(self, x: np.ndarray, top: np.ndarray, layers: list[np.ndarray]):
        self.x, self.top, self.layers = x, top, layers

    @classmethod
    def build(cls, x: np.ndarray, keys: np.ndarray) -> Graph:
        """``keys``: hashes that order the vertices and give them levels."""
        n = len(x)
        level = np.floor(-np.log((keys >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54) / np.log(LINKS)).astype(int)
        height = int(level.max(initial=0))
        # vertex n stands for a missing link
        layers = [np.full((n + 1, 2 * LINKS if k == 0 else LINKS), n) for k in range(height + 1)]
        order = np.lexsort((keys, -level))  # high vertices first: they are the entries of the rest
        graph = cls(x, np.minimum(level, height), layers)
        at, size = 1, 1
        while at < n:
            batch = order[at : at + size]
            graph._insert(order[:at], batch)
            at, size = at + len(batch), min(BATCH, 2 * size)
        return graph

    def _insert(self, held: np.ndarray, batch: np.ndarray) -> None:
        entry = np.full((len(batch), 1), held[0])
        for k in range(len(self.layers) - 1, -1, -1):
            new = batch[self.top[batch] >= k]
            ids, sims = beam_search(self.x, self.layers[k], self.x[batch], entry, BUILD_BEAM if len(new) else 1)
            if len(new):
                among = self.top[batch] >= k
                own = self.x[new] @ self.x[new].T
                np.fill_diagonal(own, -np.inf)
                near = np.concatenate([ids[among], np.broadcast_to(new, (len(new), len(new)))], axis=1)
                self._link(k, new, near, np.concatenate([sims[among], own], axis=1))
            entry = np.where(ids[:, :1] < 0, held[0], ids[:, :1])

    def _link(self, k: int, new: np.ndarray, near: np.ndarray, sims: np.ndarray) -> None:
        links, most = self.layers[k], LINKS
        best = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * most]
        near, sims = np.take_along_axis(near, best, 1), np.take_along_axis(sims, best, 1)
        near = np.where(sims == -np.inf, len(self.x), near)
        links[new, :most] = spread(self.x, near, sims, most)
        # links back; a full vertex keeps those that spread best
        ends, starts = links[new, :most].ravel(), np.repeat(new, most)
        ends, starts = ends[ends < len(self.x)], starts[ends < len(self.x)]
        order = np.argsort(ends, kind="stable")
        touched, first, counts = np.unique(ends[order], return_index=True, return_counts=True)
        room = links.shape[1]
        more = np.full((len(touched), int(counts.max(initial=0))), len(self.x))
        more[np.repeat(np.arange(len(touched)), counts), np.arange(len(ends)) - np.repeat(first, counts)] = starts[order]
        both = np.concatenate([links[touched], more], axis=1)
        got = np.einsum("bmd,bd->bm", self.x[np.minimum(both, len(self.x) - 1)], self.x[touched])
        got[both == len(self.x)] = -np.inf
        best = np.argsort(-got, axis=1, kind="stable")
        both, got = np.take_along_axis(both, best, 1), np.take_along_axis(got, best, 1)
        full = both[:, room] < len(self.x) if both.shape[1] > room else np.zeros(len(touched), dtype=bool)
        links[touched[~full]] = both[~full, :room]
        if full.any():
            links[touched[full]] = spread(self.x, both[full], got[full], room)

    def unreached(self) -> np.ndarray:
        """Vertices of the lowest layer that no path from the entry meets."""
        n = len(self.x)
        met = np.zeros(n + 1, dtype=bool)
        met[n] = True  # the place of missing links
        front = np.array([int(np.argmax(self.top))]) if n else np.zeros(0, dtype=int)
        while len(front):
            met[front] = True
            front = np.unique(self.layers[0][front])
            front = front[~met[front]]
        return np.flatnonzero(~met)

    def search(self, asked: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        if width >= len(self.x):  # the widest beam holds the whole shard
            sims = asked @ self.x.T
            return np.broadcast_to(np.arange(len(self.x)), sims.shape), sims
        start = int(np.argmax(self.top))
        entry = np.full((len(asked), 1), start)
        for k in range(len(self.layers) - 1, 0, -1):
            entry, _ = beam_search(self.x, self.layers[k], asked, entry, 1)
        return beam_search(self.x, self.layers[0], asked, entry, width)


def spread(x: np.ndarray, near: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of each row's neighbours, nearest first, those that are nearer to the
    vertex than to any taken before, then the nearest of the others."""
    n, wide = len(x), near.shape[1]
    among = np.einsum("bmd,bkd->bmk", x[np.minimum(near, n - 1)], x[np.minimum(near, n - 1)])
    taken = np.zeros(near.shape, dtype=bool)
    count = np.zeros(len(near), dtype=int)
    for j in range(wide):
        worst = np.where(taken, among[:, j, :], -np.inf).max(axis=1)
        ok = (near[:, j] < n) & (worst <= sims[:, j]) & (count < most)
        taken[ok, j] = True
        count += ok
    rank = np.argsort(~taken, axis=1, kind="stable")[:, :most]
    out = np.full((len(near), most), n)
    picked = np.take_along_axis(near, rank, 1)
    out[:, : picked.shape[1]] = picked
    return out


def audit(exact: np.ndarray, asked: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """A bounded random sample of the vertices, and a probe for each: the vertex
    turned towards a random query until their cosine is ``threshold``."""
    rng = np.random.default_rng(11)
    places = rng.permutation(len(exact))[:AUDIT_PROBES]
    held, towards = exact[places], asked[rng.integers(len(asked), size=len(places))]
    aside = towards - (towards * held).sum(axis=1, keepdims=True) * held
    size = np.linalg.norm(aside, axis=1, keepdims=True)
    probes = threshold * held + np.sqrt(max(0.0, 1 - threshold**2)) * aside / np.maximum(size, 1e-300)
    return places, np.where(size > 1e-6, probes, held)  # a query along the vertex turns it nowhere


def wider(width: int, n: int) -> int:
    """The next width: beams over a sixteenth of a shard cost more than the scan, the last step."""
    return width * WIDEN if 16 * width * WIDEN <= n else n


def audited_width(graph: Graph, exact: np.ndarray, probes: np.ndarray, threshold: float) -> int:
    """The first width whose beams hold ``RECALL`` of the probes' links, or are
    full of links (they are widened later); the number of vertices if none does."""
    n, width = len(exact), BEAM
    true = probes @ exact.T >= threshold - 1e-9
    while width < n:
        ids, sims = graph.search(probes.astype(np.float32), width)
        found = (np.take_along_axis(true, np.maximum(ids, 0), 1) & (ids >= 0)).sum(axis=1)
        held = np.where((sims >= threshold - SLACK).all(axis=1), 1.0, found / np.maximum(true.sum(axis=1), 1))
        if held.mean() >= RECALL:
            break
        width = wider(width, n)
    return min(width, n)


def scan(exact: np.ndarray, asked: np.ndarray, threshold: float) -> np.ndarray:
    """The links of queries that are compared with every vertex."""
    return asked @ exact.T >= threshold


def find_links(graph: Graph, exact: np.ndarray, asked: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix (queries x vertices) of pairs with cosine >= threshold;
    ``exact`` and ``asked`` hold unit vectors in double precision."""
    n = len(exact)
    out = np.zeros((len(asked), n), dtype=bool)
    single = asked.astype(np.float32)
    width = audited_width(graph, exact, audit(exact, asked, threshold)[1], threshold)
    cut_off = graph.unreached()
    if len(cut_off):
        out[:, cut_off] = asked @ exact[cut_off].T >= threshold
    todo = np.arange(len(asked))
    while len(todo):
        full = []
        for at in range(0, len(todo), BATCH):
            rows = todo[at : at + BATCH]
            if width >= n:
                out[rows] |= scan(exact, asked[rows], threshold)
                continue
            ids, sims = graph.search(single[rows], width)
            near = sims >= threshold - SLACK
            i, j = np.nonzero(near)
            i, j = rows[i], ids[i, j]
            good = np.einsum("pd,pd->p", exact[j], asked[i]) >= threshold
            out[i[good], j[good]] = True
            full.append(rows[near.all(axis=1)])
        todo = np.concatenate(full) if full else todo[:0]
        width = wider(width, n)
    return out


def forest(links: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what the links (rows x columns) join."""
    edges, free_rows, free_columns = [], links.any(axis=1), np.ones(links.shape[1], dtype=bool)
    for i in np.flatnonzero(free_rows):
        if not free_rows[i]:
            continue
        free_rows[i] = False
        front = np.array([i])
        while len(front):
            got = np.flatnonzero(links[front].any(axis=0) & free_columns)
            free_columns[got] = False
            edges += [(int(rows[i]), int(columns[c])) for c in got if rows[i] != columns[c]]
            front = np.flatnonzero(links[:, got].any(axis=1) & free_rows) if len(got) else got
            free_rows[front] = False
            edges += [(int(rows[i]), int(rows[r])) for r in front]
    return edges


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93, shard: int = SHARD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, embedding,
    label)."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    kind = F.concat_ws(":", F.size("embedding"), "label")  # vectors of one length and label are compared
    good = usable(rows.filter("label is not null")).withColumn("label", kind)
    # vertices: distinct vectors of a label, named by their smallest id
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x * x))
    vertices = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    vertices = materialize(vertices.withColumn("unit", F.transform("embedding", lambda x: x / norm)), "vertices")
    shards = materialize(vertices.groupBy("label").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards")), "shards")
    dealt = vertices.join(shards, "label").withColumn("shard", F.pmod(F.xxhash64("id", "label"), F.col("shards")).cast("int"))
    dealt = dealt.select("label", "shards", "shard", "id", "copies", "unit")

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending")])
        x = matrix(group["unit"], np.float32)
        graph = Graph.build(x, mix64(group["id"].to_numpy().view(np.uint64)))
        links = [[layer[i].tolist() for layer in graph.layers[: graph.top[i] + 1]] for i in range(len(x))]
        return group.append_column("place", pa.array(np.arange(len(x)), pa.int32())).append_column("links", pa.array(links, pa.list_(pa.list_(pa.int32()))))

    schema = "label string, shards int, shard int, id long, copies long, unit array<double>, place int, links array<array<int>>"
    graphs = materialize(dealt.groupBy("label", "shard").applyInArrow(lambda t: build(t), schema), "graphs")
    pairs = F.transform(F.sequence(F.lit(0), F.col("shards") - 1), lambda other: F.struct(F.least("shard", other).alias("one"), F.greatest("shard", other).alias("two")))
    meeting = graphs.withColumn("pair", F.explode(pairs)).select("label", "pair.one", "pair.two", "shard", "id", "copies", "unit", "place", "links")

    def load(group: pa.Table) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
        group = group.sort_by([("place", "ascending")])
        unit, links = matrix(group["unit"]), group["links"].to_pylist()
        top = np.array([len(x) - 1 for x in links], dtype=int)
        layers = []
        for k in range(int(top.max(initial=0)) + 1):
            layer = np.full((len(unit) + 1, 2 * LINKS if k == 0 else LINKS), len(unit))
            there = np.flatnonzero(top >= k)
            layer[there] = np.array([links[i][k] for i in there])
            layers.append(layer)
        return Graph(unit.astype(np.float32), top, layers), unit, group["id"].to_numpy(), group["copies"].to_numpy()

    def meet(group: pa.Table) -> pa.Table:
        one, two = group["one"][0].as_py(), group["two"][0].as_py()
        shard_of = group["shard"].to_numpy()
        graph_a, a, ids_a, copies_a = load(group.filter(pa.array(shard_of == one)))
        if one == two:
            links = find_links(graph_a, a, a, threshold)
            links |= links.T
            np.fill_diagonal(links, False)
            counts = [(ids_a, links.astype(np.float32) @ copies_a)]
            ids_b = ids_a
        else:
            graph_b, b, ids_b, copies_b = load(group.filter(pa.array(shard_of == two)))
            if not len(a) or not len(b):
                return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
            links = find_links(graph_b, b, a, threshold) | find_links(graph_a, a, b, threshold).T
            counts = [(ids_a, links.astype(np.float32) @ copies_b), (ids_b, links.T.astype(np.float32) @ copies_a)]
        out = [(int(i), None, int(round(n))) for ids, ns in counts for i, n in zip(ids, ns, strict=True) if n]
        out += [(x, y, 0) for x, y in forest(links, ids_a, ids_b)]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip("abn", columns, strict=True)})

    found = materialize(meeting.groupBy("label", "one", "two").applyInArrow(lambda t: meet(t), "a long, b long, n long"), "links")
    counts = found.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    parts = connected_components(vertices.select("id").distinct(), found.filter("b is not null").select("a", "b"))
    placed = vertices.select("label", "embedding", "id", "copies").join(counts, "id", "left").join(parts, "id")
    placed = materialize(placed.select(F.col("label").alias("__label"), F.col("embedding").alias("__vector"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("component").alias("component_id")), "placed")
    joined = rows.join(placed, F.col("label").isNotNull() & (kind == F.col("__label")) & (F.col("embedding") == F.col("__vector")) & F.col("vec_id").isNotNull(), "left")
    out = joined.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
