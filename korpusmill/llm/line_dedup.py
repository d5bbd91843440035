"""Line deduplication by sharded minimal perfect hashing.

Lines never meet in a join. Documents give 128-bit line keys, which are dealt
to shards. Each shard counts the documents of its distinct keys and gets a
minimal perfect hash over them (a cascade of bit arrays, each holding the keys
that are alone in their slot) whose slots number compact arrays: fingerprint,
count of documents, and first document. The shard's lines probe the arrays,
and the counts decide which of them go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korpusmill.llm.common import SPACE_BYTES, doc_order, free_name, with_fields
from korpusmill.session import shared_folder, store

MIN_CHARS = 10
#: Lines a shard holds on average while there are fewer shards than MAX_SHARDS, and lines beyond which it is cut in slices.
SHARD_KEYS, MAX_SHARDS, SLICE_PROBES = 1 << 17, 1 << 16, 1 << 20


def line_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """A 16-byte key for each line of the text, None for lines too short to count."""
    keys = []
    for line in (text or "").encode().lower().split(b"\n"):  # bytes.lower() touches A-Z alone
        line = line.strip(SPACE_BYTES)
        long = len(line) >= min_chars and (len(line) >= 4 * min_chars or len(line.decode()) >= min_chars)
        keys.append(xxhash.xxh3_128_digest(line) if long else None)
    return keys


def _halves(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)


def _emit_keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = set(line_keys(text.as_py(), min_chars)) - {None}
                docs += [doc] * len(own)
                keys += own
            hi, lo = _halves(keys).T
            yield pa.record_batch({"doc": pa.array(docs, pa.int64()), "hi": pa.array(hi), "lo": pa.array(lo)})

    return run


# --- the minimal perfect hash of one shard
def _spot(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    x = (hi ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29)) ^ lo) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


def build_hash(hi: np.ndarray, lo: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """Level sizes, their bits, and each key's slot in 0 .. n-1. The keys (pairs of uint64) must be distinct."""
    left, before = np.arange(len(hi)), 0
    sizes, bits, slot = [], [], np.empty(len(hi), np.int64)
    while len(left):
        size = -(-2 * len(left) // 64) * 64
        spot = _spot(hi[left], lo[left], len(sizes), size)
        alone = np.bincount(spot, minlength=size) == 1
        rank = np.cumsum(alone) - 1 + before
        mine = alone[spot]
        slot[left[mine]] = rank[spot[mine]]
        before += int(alone.sum())
        sizes.append(size)
        bits.append(np.packbits(alone, bitorder="little").tobytes())
        left = left[~mine]
    return sizes, b"".join(bits), slot


class Lookup:
    """Slots of keys; -1 for most keys that are not members. Members always get their own slot."""

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes, self.bytes = sizes, np.frombuffer(bits, np.uint8)
        words = np.frombuffer(bits, np.uint64)
        self.words, self.before = words, np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        out, left, at = np.full(len(hi), -1, np.int64), np.arange(len(hi)), 0
        for level, size in enumerate(self.sizes):
            spot = _spot(hi[left], lo[left], level, size)
            word, bit = self.words[(at + spot) >> 6], (spot & 63).astype(np.uint64)
            found = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[found]] = (self.before[(at + spot) >> 6] + below)[found]
            left, at = left[~found], at + size
        return out


_INDEX = "shard int, sizes array<int>, bits binary, prints binary, counts binary, firsts binary"


_TALLY = "shard int, hi bigint, lo bigint, n bigint, first bigint"


def _distinct(hi: np.ndarray, lo: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of key, then ``within``, and where in this order a key begins."""
    order = np.lexsort((within, lo, hi))
    changes = (np.diff(hi[order]) != 0) | (np.diff(lo[order]) != 0)
    return order, np.flatnonzero(np.append(True, changes))


def _tally(lines: pa.Table) -> pa.Table:
    """Each distinct key of a shard, or of a slice of it, with its number of documents and the first of them."""
    hi, lo, doc = (lines[c].to_numpy() for c in ("hi", "lo", "doc"))
    order, starts = _distinct(hi, lo, doc)
    docs = doc[order]
    fresh = np.append(True, np.diff(docs) != 0)
    fresh[starts] = True  # a document that holds the line twice, or has several rows, counts once
    n, at = np.add.reduceat(fresh.astype(np.int64), starts), order[starts]
    shard = np.full(len(at), lines["shard"][0].as_py(), np.int32)
    return pa.table({"shard": shard, "hi": hi[at], "lo": lo[at], "n": n, "first": docs[starts]})


def _build_shard(tallies: pa.Table) -> pa.Table:
    """The arrays of one shard. Slices hold different documents, so their counts add up."""
    hi, lo, n, first = (tallies[c].to_numpy() for c in ("hi", "lo", "n", "first"))
    order, starts = _distinct(hi, lo, first)
    total, at = np.minimum(np.add.reduceat(n[order], starts), 2**31 - 1), order[starts]
    hi, lo, first = hi[at].view(np.uint64), lo[at].view(np.uint64), first[at]
    sizes, bits, slot = build_hash(hi, lo)
    prints, counts, firsts = np.empty(len(hi), np.uint64), np.empty(len(hi), np.int32), np.empty(len(hi), np.int64)
    prints[slot], counts[slot], firsts[slot] = lo, total, first
    row = {"shard": [tallies["shard"][0].as_py()], "sizes": [sizes], "bits": [bits], "prints": [prints.tobytes()], "counts": [counts.tobytes()], "firsts": [firsts.tobytes()]}
    return pa.table(row, pa.schema([("shard", pa.int32()), ("sizes", pa.list_(pa.int32()))] + [(c, pa.binary()) for c in ("bits", "prints", "counts", "firsts")]))


def _probe(min_docs: int):
    def run(lines: pa.Table, index: pa.Table) -> pa.Table:
        probes = lines.select(["doc", "hi", "lo"])
        if not index.num_rows or not probes.num_rows:
            return probes.slice(0, 0)
        row = {c: index[c][0].as_py() for c in ("sizes", "bits", "prints", "counts", "firsts")}
        hi, lo = (probes[c].to_numpy().view(np.uint64) for c in ("hi", "lo"))
        slot = Lookup(row["sizes"], row["bits"]).slots(hi, lo)
        at = np.maximum(slot, 0)
        known = (slot >= 0) & (np.frombuffer(row["prints"], np.uint64)[at] == lo)
        shared = np.frombuffer(row["counts"], np.int32)[at] >= min_docs
        later = probes["doc"].to_numpy() > np.frombuffer(row["firsts"], np.int64)[at]
        return probes.filter(pa.array(known & shared & later))

    return run


def _cut(min_chars: int, doc_name: str, drop_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            names = batch.schema.names
            for text, drop in zip(batch.column(names.index("text")), batch.column(names.index(drop_name))):
                text = text.as_py() or ""
                lines = text.split("\n")
                n_lines.append(len(lines))
                if drop.is_valid:
                    gone = {d["hi"].to_bytes(8, "little", signed=True) + d["lo"].to_bytes(8, "little", signed=True) for d in drop.as_py()}
                    lines = [x for x, k in zip(lines, line_keys(text, min_chars)) if k not in gone]
                    text = "\n".join(lines)
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append(text)
            new = {"kept_text": pa.array(kept, pa.string()), "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())}
            old = {n: c for n, c in zip(names, batch.columns) if n not in {*new, drop_name, doc_name}}
            yield pa.RecordBatch.from_pydict(old | new)

    return run


def dropped_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Of ``lines`` (doc, hi, lo) those that ``min_docs`` documents hold, but not those of the first of them.

    A shard is one task that counts, indexes and probes. One with many lines,
    as a hot line makes it, is cut in slices by document; these are counted
    each for itself, the counts make one index, and each slice probes a copy.
    """
    shards = min(MAX_SHARDS, max(1, -(-lines.count() // SHARD_KEYS)))
    dealt = lines.withColumn("shard", F.pmod("hi", F.lit(shards)).cast("int"))
    sizes = dealt.groupBy("shard").agg(F.ceil(F.count("*") / SLICE_PROBES).cast("int").alias("slices"))
    cuts = sizes.where("slices > 1").collect()  # a row a shard at most
    hot = lambda: F.broadcast(lines.sparkSession.createDataFrame(cuts, "shard int, slices int"))
    probe, found = _probe(min_docs), "doc bigint, hi bigint, lo bigint"

    whole = dealt.join(hot(), "shard", "left_anti").groupBy("shard")
    dropped = whole.applyInArrow(lambda own: probe(own, _build_shard(_tally(own))), found)
    if cuts:
        sliced = dealt.join(hot(), "shard").withColumn("slice", F.pmod(F.xxhash64("doc"), "slices").cast("int"))
        tallies = sliced.groupBy("shard", "slice").applyInArrow(_tally, _TALLY)
        index = tallies.groupBy("shard").applyInArrow(_build_shard, _INDEX).join(hot(), "shard")
        index = index.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        probed = sliced.groupBy("shard", "slice").cogroup(index.groupBy("shard", "slice"))
        dropped = dropped.unionByName(probed.applyInArrow(probe, found))
    return dropped


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = 2) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased.
    Keys of at least ``min_chars`` code points that at least ``min_docs``
    documents hold lose their lines everywhere but in the smallest doc_id.
    Repeats within that document stay.

    A null or empty text is one empty line and stays empty. Rows with one
    doc_id are one document; rows without doc_id are one document that comes
    last. Empty tables give empty results. Other columns stay, whatever their
    names, except that the three named ones are replaced. Texts are handled
    row by row, whole.

    There are at most ``MAX_SHARDS`` shards, so the table of slices is small
    enough to broadcast.
    """
    spark = docs.sparkSession
    lines = docs.select(doc_order().alias("doc"), F.col("text")).mapInArrow(_emit_keys(min_chars), "doc bigint, hi bigint, lo bigint")
    lines = store(lines, shared_folder(spark, "line-keys"))
    doc_name, drop_name = free_name(docs, "doc"), free_name(docs, "drop")
    drop = dropped_lines(lines, min_docs).groupBy(F.col("doc").alias(doc_name)).agg(F.collect_list(F.struct("hi", "lo")).alias(drop_name))
    joined = docs.withColumn(doc_name, doc_order()).join(drop, doc_name, "left")
    schema = with_fields(docs, "kept_text string, n_lines bigint, n_dropped bigint")
    return joined.mapInArrow(_cut(min_chars, doc_name, drop_name), schema)
