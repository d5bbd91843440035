"""Near-duplicate documents: MinHash bands, odd sketches, and a full check of every link.

A document's word shingles give ``BANDS * ROWS`` MinHash samples. Documents that
agree on all samples of a band are candidates. The samples are also folded into
an odd sketch, a bitmap of parities: the number of bits by which two sketches
differ estimates how many samples differ, and most accurately for similar
sets. Candidates that the sketches let through are compared on their whole sets.

Groups of copies are never expanded into pairs. Equal sets are one node. A
bucket's pivot is its smallest node, and each node is compared with two of its
pivots first: the smallest, and the one it shares most bands with. Buckets that
then still hold several components are searched for links across components, in
blocks of bounded size that give only as many links as join them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korpusmill.llm.components import components
from korpusmill.session import shared_folder, store

#: A pair at similarity 0.8 shares no band once in 190,000 times: (1 - 0.8 ** 6) ** 40.
BANDS, ROWS, SKETCH_BITS = 40, 6, 512
#: Nodes of one side that one comparison of blocks takes on average.
BLOCK = 1024
_CHUNK = 4096


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's word shingles; all its words as one if there are fewer."""
    tokens = (text or "").encode().lower().split()  # bytes: ASCII white space and A-Z alone
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, tokens)), np.uint64)
    size = min(words, len(h))
    x = np.full(len(h) - size + 1, 0x9E3779B97F4A7C15 * size & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for k in range(size):
        x = (x ^ h[k : k + len(x)]) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
    return np.unique(x)


def _samples(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), _CHUNK):
        np.minimum(least, (a[:, None] * x[None, at : at + _CHUNK] + b[:, None]).min(axis=1), out=least)
    return least


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_sketches(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """A bitmap for each row of samples, as bytes: a bit is set if an odd number of samples fell on it."""
    n, k = samples.shape
    spot = _mix(samples.astype(np.uint64) + (np.arange(1, k + 1, dtype=np.uint64) << np.uint64(32))) % np.uint64(bits)
    flat = (np.arange(n, dtype=np.int64) * bits)[:, None] + spot.astype(np.int64)
    return np.packbits((np.bincount(flat.ravel(), minlength=n * bits) & 1).astype(bool).reshape(n, bits), axis=1)


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = samples.reshape(len(samples), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def most_differing_bits(threshold: float, samples: int, bits: int = SKETCH_BITS) -> int:
    """Bits by which the sketches of a pair at the threshold differ, six standard deviations up."""
    m = 2 * samples * (1 - threshold)
    drawn = 2 * math.sqrt(samples * threshold * (1 - threshold)) * math.exp(-2 * m / bits)
    folded = math.sqrt(bits / 4 * (1 - math.exp(-4 * m / bits)))
    return math.ceil(bits / 2 * (1 - math.exp(-2 * m / bits)) + 6 * math.hypot(drawn, folded))


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(hashes.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _describe(words: int, bands: int, rows: int):
    """Every row's set size, digest of the set, sketch and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(20240607)
        a = rng.integers(0, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
        b = rng.integers(0, 1 << 32, bands * rows, np.uint32)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sizes, digests = [], []
                samples = np.zeros((batch.num_rows, bands * rows), np.uint32)
                for i, text in enumerate(batch.column(1)):
                    hashes = shingle_hashes(text.as_py(), words)
                    sizes.append(len(hashes))
                    digests.append(_digest(hashes) if len(hashes) else (None, None))
                    if len(hashes):
                        samples[i] = _samples(hashes, a, b)
                keys = band_keys(samples, bands, rows)
                yield pa.record_batch({
                    "doc": batch.column(0), "n": pa.array(sizes, pa.int64()),
                    "hi": pa.array([d[0] for d in digests], pa.int64()), "lo": pa.array([d[1] for d in digests], pa.int64()),
                    "sketch": pa.array([s.tobytes() for s in odd_sketches(samples)], pa.binary()),
                    "bands": pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), keys.ravel()),
                })

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t.as_py(), words).tobytes() for t in batch.column(1)]
            yield pa.record_batch({"node": batch.column(0), "hashes": pa.array(sets, pa.binary())})

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                links.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch({"a": batch.column(0), "b": batch.column(1), "link": pa.array(links, pa.bool_())})

    return run


def _region_links(percent: int):
    """Links across components in one comparison of blocks, as many as it takes to join them; decided on whole sets."""

    def run(table: pa.Table) -> pa.Table:
        node, comp, left, right = (table[c].to_numpy() for c in ("node", "comp", "left", "right"))
        sets = [np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()]
        xs, ys = np.flatnonzero(left), np.flatnonzero(right)
        sizes = np.array([len(h) for h in sets])
        posted, owner = np.concatenate([sets[y] for y in ys] or [np.empty(0, np.uint64)]), np.repeat(np.arange(len(ys)), sizes[ys])
        order = np.argsort(posted, kind="stable")
        posted, owner = posted[order], owner[order]
        _, label = np.unique(comp, return_inverse=True)
        found = []
        for x in xs:
            low, high = np.searchsorted(posted, sets[x], "left"), np.searchsorted(posted, sets[x], "right")
            n = high - low
            at = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(ys))
            for y in ys[100 * both >= percent * (sizes[x] + sizes[ys] - both)]:
                if label[x] != label[y]:
                    label[label == label[y]] = label[x]
                    found.append((node[x], node[y]))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return run


def _check(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, most: int) -> DataFrame:
    """``a, b, link`` for those ``pairs`` whose sketches are close, decided on whole sets; stored."""
    spark = pairs.sparkSession
    sketch = lambda c: nodes.select(F.col("node").alias(c), F.col("sketch").alias(f"s{c}"))
    seen = pairs.join(sketch("a"), "a").join(sketch("b"), "b")
    seen = seen.mapInArrow(_near(most), "a bigint, b bigint")
    seen = store(seen, shared_folder(spark, "candidates"))
    own = lambda c: sets.select(F.col("node").alias(c), F.col("hashes").alias(f"h{c}"))
    both = seen.join(own("b"), "b").join(own("a"), "a").select("a", "b", "ha", "hb")
    return store(both.mapInArrow(_linked(percent), "a bigint, b bigint, link boolean"), shared_folder(spark, "links"))


def _stored_sets(ids: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """``node, hashes`` for the documents ``ids`` (node)."""
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(ids, "node", "left_semi")
    return store(texts.mapInArrow(_sets(words), "node bigint, hashes binary"), shared_folder(docs.sparkSession, "shingle-sets"))


def _near(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            x, y = (np.frombuffer(b"".join(batch.column(names.index(c)).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            near = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int32) <= most
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _links_across(met: DataFrame, tried: DataFrame, nodes: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a bucket, ``a, b``.

    A bucket's largest component is its main one, all other nodes are strays.
    All strays of a main component are compared with each other and with its
    nodes, block by block. Buckets of two nodes that were ``tried`` are done.
    """
    labels = roots.join(roots.groupBy("root").agg(F.count("*").alias("size")), "root")
    named = nodes.select("node").distinct().join(labels, "node", "left")
    named = named.select("node", F.coalesce("root", "node").alias("comp"), F.coalesce("size", F.lit(1)).alias("size"))
    named = store(named, shared_folder(met.sparkSession, "components"))

    comp = met.select("key", "node").join(named, "node")
    mixed = comp.groupBy("key").agg(
        F.count("*").alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.max(F.struct("size", "comp"))["comp"].alias("main"),
        F.min("node").alias("a"), F.max("node").alias("b"),
    ).where("c0 < c1")
    done = tried.select("a", "b", F.lit(2).cast("bigint").alias("m"))
    mixed = mixed.join(done, ["a", "b", "m"], "left_anti").select("key", "main")
    strays = comp.join(mixed, "key").where("comp <> main").select("main", "node", "comp").distinct().withColumn("stray", F.lit(True))
    strays = store(strays, shared_folder(met.sparkSession, "strays"))
    mains = named.join(strays.select(F.col("main").alias("comp")).distinct(), "comp")
    region = strays.unionByName(mains.select(F.col("comp").alias("main"), "node", "comp", F.lit(False).alias("stray")))

    share = lambda c: F.greatest(F.lit(1), F.ceil(F.sum(c.cast("int")) / BLOCK)).cast("int")
    n = region.groupBy("main").agg(share(F.col("stray")).alias("strays"), share(~F.col("stray")).alias("mains"))
    # A stray block meets each block of strays from its own number on, and every main block (numbered -1, -2, ...).
    own = F.pmod(F.xxhash64("node"), F.when(F.col("stray"), F.col("strays")).otherwise(F.col("mains"))).cast("int")
    i, pair = F.col("own"), lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    from_stray = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("strays") - 1), lambda j: pair(F.least(i, j), F.greatest(i, j))),
        F.transform(F.sequence(F.lit(1), F.col("mains")), lambda j: pair(i, -j)),
    )
    from_main = F.transform(F.sequence(F.lit(0), F.col("strays") - 1), lambda j: pair(j, -i - 1))
    dealt = region.join(n, "main").withColumn("own", own).withColumn("p", F.explode(F.when(F.col("stray"), from_stray).otherwise(from_main)))
    mine = F.when(F.col("stray"), F.col("own")).otherwise(-F.col("own") - 1)
    dealt = dealt.select("main", "node", "comp", "p.x", "p.y", (mine == F.col("p.x")).alias("left"), (mine == F.col("p.y")).alias("right"))
    return dealt.join(sets, "node").groupBy("main", "x", "y").applyInArrow(_region_links(percent), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text).

    Documents are linked if their sets of ``words``-word shingles (A-Z
    lower-cased, words between ASCII white space) have a Jaccard similarity of
    at least ``percent`` / 100. ``component_id`` is the smallest doc_id that
    links reach. A text with fewer words is one shingle; null, empty and blank
    texts have none and are linked with nothing. Every link is confirmed on
    whole sets. Rows with one doc_id are one document. Rows without doc_id are
    linked with nothing: no component, kept. Other columns are ignored.
    """
    spark, most = docs.sparkSession, most_differing_bits(percent / 100, bands * rows)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    seen = docs.mapInArrow(_describe(words, bands, rows), "doc bigint, n bigint, hi bigint, lo bigint, sketch binary, bands array<bigint>")
    seen = store(seen, shared_folder(spark, "minhash"))
    known = seen.where("doc IS NOT NULL AND n > 0")
    classes = known.groupBy("hi", "lo").agg(F.min("doc").alias("node"))
    nodes = known.join(classes.select("hi", "lo", "node"), ["hi", "lo"]).where("doc = node")
    nodes = store(nodes.select("node", "sketch", "bands").dropDuplicates(["node", "sketch"]), shared_folder(spark, "nodes"))

    rows_ = nodes.select("node", F.explode("bands").alias("key"))
    pivots = rows_.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last").select("key", "a")
    met = store(rows_.join(pivots, "key").select("key", "a", "node"), shared_folder(spark, "buckets"))
    shared = met.where("a < node").groupBy("node", "a").agg(F.count("*").alias("times"))
    picks = shared.groupBy("node").agg(F.array_distinct(F.array(F.min("a"), F.max_by("a", F.struct("times", -F.col("a"))))).alias("picks"))
    tried = store(picks.select(F.explode("picks").alias("a"), F.col("node").alias("b")), shared_folder(spark, "tried"))
    sets = _stored_sets(met.select("node").distinct(), docs, words)
    links = _check(tried, nodes, sets, percent, most).where("link").select("a", "b")
    roots = components(links)
    links = roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(_links_across(met, tried, nodes, roots, sets, percent))

    member = known.select("doc", "hi", "lo").join(classes, ["hi", "lo"]).groupBy("doc").agg(F.min("node").alias("node"), F.max("node").alias("other"))
    member = store(member, shared_folder(spark, "members"))
    several = known.select("doc", "hi", "lo").join(classes, ["hi", "lo"]).join(member.where("node < other").select("doc", F.col("node").alias("a")), "doc")
    roots = components(links.unionByName(several.select("a", F.col("node").alias("b"))))
    part = member.join(roots, "node", "left").select("doc", F.coalesce("root", "node").alias("root"))
    out = seen.select("doc", "n").join(part, "doc", "left")
    component = F.coalesce("root", "doc")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that have a smaller doc_id in their component; all columns stay."""
    gone = near_duplicates(docs, words, percent).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("bigint") == F.col("_gone"), "left_anti")
