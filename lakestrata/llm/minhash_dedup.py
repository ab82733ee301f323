"""MinHash near-duplicates with sequential Bayesian verification.

Documents are sets of distinct word shingles.  Texts with equal sets are one
candidate, represented by the smallest id.  Signatures are cut into bands;
representatives that share a band are compared batch by batch of their
signatures: after each batch the posterior of their similarity (uniform prior)
is looked up, and a pair is dropped once its chance of reaching the threshold
is too small (see below).  Survivors are verified on their full sets, and verified
links are joined into components.

No bucket is expanded into all its pairs.  First each bucket is a star around
its smallest id; most links are found there.  Where that leaves a bucket in
several components, its members outside the largest are strays: they are
compared with all members of that component and with its other strays, in
blocks, with the sets at hand, and a pair is passed over only if links of its
block join it already.  So every pair of a bucket is linked, ruled out, or
joined through others, and the components are those of all pairs.

Scale: one pass over the texts writes signatures (about 0.7 KB a document); a
second pass over the texts of survivors alone writes their sets.  Hot sets, buckets
and centres are dealt by joins of scans, which Spark can split, or aggregated
before they are shuffled.

Chances: bands and rows follow from the threshold, as the longest bands that
lose at most ``BAND_MISS`` of the pairs at it; the posterior's limit starts at
``MISS`` and is halved until all looks together lose at most ``LOOK_MISS``.  So a
pair at the threshold is lost in at most 1 of 10,000 cases, and more similar ones
more rarely: at 0.80 (24 bands of 5) 7.3e-5 by bands and 1.6e-5 by looks, 8.9e-5
in all; at 0.85 (20 bands of 6) 7.8e-5 and 0.9e-5, 8.7e-5 in all.  Thresholds too
low for ``HASHES`` are refused.  Shingles are compared by 64-bit hashes.

Defined cases: null and empty texts have no shingles and link with nothing; a
row with null doc_id links with nothing, has a null component and is kept;
rows that repeat an id and a text are one document with as many rows; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import blocks, materialize, mix64, word_hashes
from lakestrata.llm.components import connected_components

HASHES = 120
BATCH = 24
MISS = 1e-4
#: Most pairs at the threshold that may share no band, and that the looks may drop together.
BAND_MISS, LOOK_MISS = 8e-5, 2e-5
#: Documents on either side of one block of comparisons.
BLOCK = 512
#: Ids of survivors that are broadcast to the scan of their texts; more are shuffled.
BROADCAST_IDS = 1_000_000

_ODD = np.random.default_rng(20_07).integers(0, 2**63, size=(HASHES, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLY, _ADD = _ODD[:, :1], _ODD[:, 1:]
_PLACES = np.array([0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x9FB21C651E98DF25], dtype=np.uint64)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of ``width`` words."""
    words, offsets = word_hashes(texts)
    places = mix64(np.arange(1, width + 1, dtype=np.uint64) * _PLACES[0])
    n = max(0, len(words) - width + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        rolled += mix64(words[k : k + n] ^ places[k])
    rolled = mix64(rolled)
    out = []
    for at, end in zip(offsets[:-1], offsets[1:], strict=True):
        if end - at >= width:
            out.append(np.unique(rolled[at : end - width + 1]))
        elif end > at:
            short = mix64(words[at:end] ^ places[: end - at]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix64(short ^ places[end - at]))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least of each of ``HASHES`` hashes over the set, 32 bits each."""
    least = np.full(HASHES, 2**32 - 1, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        np.minimum(least, ((shingles[None, at : at + 2048] * _MULTIPLY + _ADD) >> np.uint64(32)).min(axis=1), out=least)
    return least.astype("<u4")


def band_loss(threshold: float, bands: int, rows: int) -> float:
    """The chance that a pair at the threshold shares no band."""
    return (1 - threshold**rows) ** bands


def banding(threshold: float) -> tuple[int, int]:
    """Bands and rows: the longest bands that lose at most ``BAND_MISS``."""
    for rows in range(HASHES, 0, -1):
        if band_loss(threshold, HASHES // rows, rows) <= BAND_MISS:
            return HASHES // rows, rows
    raise ValueError(f"{HASHES} hashes are too few for a threshold of {threshold}")


def band_keys(signatures: np.ndarray, bands: int, per_band: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    rows = signatures[:, : bands * per_band].reshape(-1, bands, per_band).astype(np.uint64)
    keys = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), rows.shape[:2]).copy()
    for k in range(per_band):
        keys = mix64(keys ^ rows[:, :, k] * _PLACES[1])
    return keys.astype(np.int64)


def least_matches(threshold: float, miss: float = MISS, batch: int = BATCH, hashes: int = HASHES) -> list[int]:
    """For each look, after ``batch`` more hashes: the fewest matches ``m`` of
    ``n`` with P(similarity >= threshold | m, n) >= miss.  With a uniform prior
    that posterior is Beta(m + 1, n - m + 1), whose upper tail is the lower
    tail of a binomial of n + 1 draws."""

    def tail(m: int, n: int) -> float:
        return sum(math.comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i) for i in range(m + 1))

    return [next(m for m in range(n + 1) if tail(m, n) >= miss) for n in range(batch, hashes + 1, batch)]


def look_loss(threshold: float, needed: list[int], batch: int = BATCH) -> float:
    """The chance that a pair at the threshold is dropped by any of the looks."""
    step = [math.comb(batch, i) * threshold**i * (1 - threshold) ** (batch - i) for i in range(batch + 1)]
    held, lost = np.ones(1), 0.0
    for least in needed:
        held = np.convolve(held, step)
        lost += held[:least].sum()
        held[:least] = 0
    return float(lost)


def looks(threshold: float) -> list[int]:
    """``least_matches`` with the limit at which all looks together lose at most
    ``LOOK_MISS`` of the pairs at the threshold."""
    miss = MISS
    while look_loss(threshold, least_matches(threshold, miss)) > LOOK_MISS:
        miss /= 2
    return least_matches(threshold, miss)


def surviving(left: np.ndarray, right: np.ndarray, needed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the rows of ``left`` and ``right`` (signatures, row by row)
    that pass all looks, and their matches."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), dtype=np.int32)
    for look, least in enumerate(needed):
        part = slice(look * BATCH, (look + 1) * BATCH)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] >= least]
    return alive, matches[alive]


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, HASHES)


def _plain(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(table[name].chunks) if table[name].num_chunks else pa.array([], table.schema.field(name).type)


def sketches(docs: DataFrame, width: int, per_cent: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, signature) of each row."""
    bands, per_band = banding(per_cent / 100)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            sets = shingle_sets(texts, width)
            full = [x for x in sets if len(x)]
            signed = np.array([signature(x) for x in full], dtype="<u4").reshape(-1, HASHES)
            keys = iter(band_keys(signed, bands, per_band).tolist())
            signed_bytes = iter([x.tobytes() for x in signed])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets], pa.binary()),
                pa.array([next(keys) if len(x) else None for x in sets], pa.list_(pa.int64())),
                pa.array([next(signed_bytes) if len(x) else None for x in sets], pa.binary()),
            ], schema=schema)

    ddl = "doc_id long, n_shingles long, set_key binary, bands array<long>, signature binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ddl)


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, shingles) of the documents named by ``ids``; shingles as bytes."""
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    found = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).join(ids, "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            sets = [x.tobytes() for x in shingle_sets(texts, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.large_binary()).cast(pa.binary())], names=["id", "shingles"])

    return found.mapInArrow(run, "id long, shingles binary")


def similar(x: np.ndarray, y: np.ndarray, per_cent: int) -> bool:
    """100 * intersection >= per_cent * union, of sorted distinct hashes."""
    least, most = sorted((len(x), len(y)))
    if 100 * least < per_cent * most:
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= per_cent * (len(x) + len(y) - common)


class Verifier:
    """Checks candidate pairs (a, b) of representatives."""

    def __init__(self, docs: DataFrame, reps: DataFrame, width: int, per_cent: int):
        self.docs, self.reps, self.width, self.per_cent = docs, reps, width, per_cent
        self.needed = looks(per_cent / 100)

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that survive the sequential test of signatures."""
        needed = self.needed
        near = F.col("an") * 100 >= F.col("bn") * self.per_cent
        near = near & (F.col("bn") * 100 >= F.col("an") * self.per_cent)
        left = self.reps.select(F.col("id").alias("a"), F.col("n_shingles").alias("an"), F.col("signature").alias("asig"))
        right = self.reps.select(F.col("id").alias("b"), F.col("n_shingles").alias("bn"), F.col("signature").alias("bsig"))
        sized = pairs.join(left.select("a", "an"), "a").join(right.select("b", "bn"), "b").filter(near).select("a", "b")
        signed = sized.join(left.select("a", "asig"), "a").join(right.select("b", "bsig"), "b").select("a", "b", "asig", "bsig")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    kept, _ = surviving(_signatures(batch.column(2)), _signatures(batch.column(3)), needed)
                    yield batch.select([0, 1]).take(pa.array(kept))

        return signed.mapInArrow(run, "a long, b long")

    def exact(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose full sets are similar enough."""
        pairs, per_cent = materialize(pairs.distinct(), "pairs"), self.per_cent
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sets = materialize(full_sets(self.docs, materialize(ids, "survivors"), self.width), "sets")
        both = pairs.join(sets.toDF("b", "bset"), "b").join(sets.toDF("a", "aset"), "a").select("a", "b", "aset", "bset")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                linked = []
                for x, y in zip(batch.column(2), batch.column(3), strict=True):
                    linked.append(similar(np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64), per_cent))
                yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

        return both.mapInArrow(run, "a long, b long").distinct()


def stray_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(main, id, component) of the members of buckets of three or more that
    lie in another component than the ``main`` one, which holds most of their
    bucket.  The pairs of smaller buckets have all been tested as stars."""
    placed = materialize(members.filter("n > 2").join(labels, "id").select("key", "id", "component"), "placed")
    shares = placed.groupBy("key", "component").agg(F.count("*").alias("share"))
    mains = shares.groupBy("key").agg(F.max(F.struct("share", "component")).alias("top"), F.count("*").alias("parts"))
    mains = materialize(mains.filter("parts > 1").select("key", F.col("top.component").alias("main")), "mains")
    strays = placed.join(mains, "key").filter("component <> main").select("main", "id", "component")
    return materialize(strays.distinct(), "strays")


def stray_links(strays: DataFrame, labels: DataFrame, reps: DataFrame, check: Verifier) -> DataFrame:
    """Links (a, b) of stray members with members of their main component and
    with its other strays.  Every such pair is tested, but those that other
    links of its block join already; both sides are dealt in blocks."""
    mains = materialize(strays.groupBy("main").agg(F.count("*").alias("strays")), "stray-mains")
    homes = labels.join(mains.select("main"), F.col("component") == F.col("main")).select("main", "id", "component")
    targets = materialize(homes.unionByName(strays.select("main", "id", "component")), "targets")
    sizes = targets.groupBy("main").agg(F.count("*").alias("targets"))
    sizes = materialize(sizes.join(mains, "main").select("main", F.ceil(F.col("targets") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("strays") / BLOCK).cast("int").alias("probes")), "blocks")
    ids = materialize(targets.select("id").distinct(), "target-ids")
    texts = full_sets(check.docs, ids, check.width).join(reps.select("id", "signature"), "id")
    rows = materialize(texts, "target-sets").join(materialize(targets.join(sizes, "main"), "sized"), "id")
    own, other = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("probes")).cast("int")
    held = rows.withColumn("block", own).withColumn("probe", F.explode(F.sequence(F.lit(0), F.col("probes") - 1))).withColumn("probing", F.lit(False))
    asked = rows.filter("component <> main").withColumn("probe", other).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("probing", F.lit(True))
    both = held.unionByName(asked).select("main", "block", "probe", "probing", "id", "component", "signature", "shingles")
    needed, per_cent = check.needed, check.per_cent

    def run(group: pa.Table) -> pa.Table:
        probing, ids = group["probing"].to_numpy(), group["id"].to_numpy()
        signed = _signatures(_plain(group, "signature"))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in group["shingles"].to_pylist()]
        _, part = np.unique(group["component"].to_numpy(), return_inverse=True)  # joined to one number by links found here
        there, links = np.flatnonzero(~probing), []
        for i in np.flatnonzero(probing):
            open_ = there[part[there] != part[i]]
            kept, matches = surviving(np.broadcast_to(signed[i], (len(open_), HASHES)), signed[open_], needed)
            for j in open_[kept][np.argsort(-matches, kind="stable")]:
                if part[j] == part[i] or not similar(sets[i], sets[j], per_cent):
                    continue
                links.append((int(ids[i]), int(ids[j])))
                part[part == part[j]] = part[i]
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

    return both.groupBy("main", "block", "probe").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, per_cent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of (doc_id, text).
    Texts are linked when 100 * intersection >= per_cent * union."""
    sketch = materialize(sketches(docs, width, per_cent), "sketches")
    known = sketch.filter("set_key is not null and doc_id is not null")
    reps = known.groupBy("set_key").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "signature")).alias("r"))
    reps = materialize(reps.select("set_key", F.col("r.doc_id").alias("id"), "r.n_shingles", "r.bands", "r.signature"), "representatives")

    banded = reps.select("id", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("id").alias("centre"), F.count("*").alias("n")).filter("n > 1")
    members = materialize(banded.join(materialize(shared, "buckets"), "key").select("key", "id", "centre", "n"), "members")

    check = Verifier(docs, reps, width, per_cent)
    nodes = reps.select("id").distinct()
    stars = materialize(members.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(), "stars")
    links = materialize(check.exact(check.likely(stars)), "links")
    labels = materialize(connected_components(nodes, links), "components")

    strays = stray_members(members, labels)
    if not strays.isEmpty():
        more = materialize(stray_links(strays, labels, reps, check), "stray-links")
        labels = materialize(connected_components(nodes, links.union(more)), "components")

    placed = materialize(reps.select("set_key", "id").join(labels, "id").select("set_key", F.col("component").alias("component_id")), "placed-sets")
    whole = sketch.filter("set_key is not null and doc_id is not null").select("doc_id", "n_shingles", "set_key").join(placed, "set_key").drop("set_key")
    alone = sketch.filter("set_key is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = whole.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_representatives(docs: DataFrame, width: int = 5, per_cent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one document of each group.  Rows that repeat
    id and text of a kept document stay once; a document stays if any of the
    rows with its id does."""
    found = near_duplicates(docs.select("doc_id", "text"), width, per_cent).filter("doc_id is not null")
    ids = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    marked = materialize(ids.filter("not kept or n > 1"), "marked")
    small = marked.count() <= BROADCAST_IDS

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df.select("doc_id")) if small else df.select("doc_id")

    once = docs.join(side(marked), "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.join(side(marked.filter("kept")), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated.select(*docs.columns))
