"""Context-triggered piecewise hashing: fingerprints that stay alike when texts are edited.

A rolling hash over seven bytes ends a chunk where it hits a residue of the
block size. Each chunk gives one character. A fingerprint has the block size,
the characters at that size, and those at twice the size; two fingerprints with
compatible sizes are compared by the edit distance of their characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.llm.common import doc_order

#: The block size follows the length, for CHUNKS chunks at most on average; texts that repeat themselves may have MOST_CHUNKS.
LEAST_BLOCK, CHUNKS, MOST_CHUNKS, ROLL, COMMON = 3, 64, 128, 7, 7
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_FACTORS = [np.uint32(pow(0x01000193, k, 1 << 32)) for k in range(ROLL)]


def _rolling(data: np.ndarray) -> np.ndarray:
    x = data.astype(np.uint32) + np.uint32(1)
    r = x.copy()
    for k in range(1, min(ROLL, len(x))):
        r[k:] += x[:-k] * _FACTORS[k]
    r ^= r >> np.uint32(15)
    r *= np.uint32(0x2C1B3C6D)
    return r ^ (r >> np.uint32(13))


def _characters(mixed: np.ndarray, ends: np.ndarray) -> str:
    """A character for each chunk; ``ends`` are the last positions of all chunks but the last."""
    starts = np.concatenate(([0], ends + 1))
    sums = np.add.reduceat(mixed, starts[starts < len(mixed)])
    sums = (sums ^ (sums >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return _ALPHABET[(sums >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str | None) -> str:
    """``size:characters:characters at twice the size``. The size is one of 3, 6, 12, ...; whole texts count, as UTF-8."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    if not len(data):
        return f"{LEAST_BLOCK}::"
    roll = _rolling(data)
    size = LEAST_BLOCK
    while size * CHUNKS < len(data):
        size *= 2
    ends = np.flatnonzero(roll % np.uint32(size) == size - 1)
    while len(ends) >= MOST_CHUNKS:
        size *= 2
        ends = ends[roll[ends] % np.uint32(size) == size - 1]
    mixed = roll.astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(33)
    wide = ends[roll[ends] % np.uint32(2 * size) == 2 * size - 1]
    return f"{size}:{_characters(mixed, ends)}:{_characters(mixed, wide)}"


def _common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit by bit in parallel."""
    seats: dict[str, int] = {}
    for i, c in enumerate(a):
        seats[c] = seats.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & seats.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0 if a else 0.0
    need = min(COMMON, max(1, min(len(a), len(b)) // 2))
    if not a or not b or {a[i : i + need] for i in range(len(a) - need + 1)}.isdisjoint(b[i : i + need] for i in range(len(b) - need + 1)):
        return 0.0  # chance matches of single characters are no likeness
    # Edits are insertions and deletions: distance = len(a) + len(b) - 2 * common.
    return 2 * _common_length(a, b) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1 from the edit distance at compatible block sizes (equal, or one twice the other); 1 for equal fingerprints."""
    if x == y:
        return 1.0
    (sx, a1, a2), (sy, b1, b2) = x.split(":"), y.split(":")
    sx, sy = int(sx), int(sy)
    if sx == sy:
        return max(_alike(a1, b1), _alike(a2, b2))
    if sx == 2 * sy:
        return _alike(a1, b2)
    return _alike(a2, b1) if sy == 2 * sx else 0.0


def fingerprint_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` for every row of ``docs``; null and empty texts have the fingerprint of the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch({"doc_id": batch.column(0), "fingerprint": pa.array(prints, pa.string())})

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, fingerprint string")


# --- documents beside their next ones
_EDITED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _beside_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket and document; a bucket ends with the first document of the next one, marked ``ahead``."""
    bucket, last = None, None
    for batch in batches:
        out = []
        for b, ahead, doc, text in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
            if b != bucket:
                bucket, last = b, None
            elif ahead and last is None:
                continue
            text = text.as_py() or ""
            own = fingerprint(text)
            if last is not None:
                before, before_text, before_print = last
                n = len(before_text)
                edited = before_text[: n - n // 4] + text[: n // 4]
                changed = fingerprint(edited)
                digest = hashlib.sha256(edited.encode()).hexdigest()
                out.append((before, n, digest, before_print, changed, likeness(before_print, changed), likeness(before_print, own)))
            last = None if ahead else (doc, text, own)
        if out:
            columns = zip(*out)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split(" ")[0] for f in _EDITED.split(", ")])


def _bucket(key: Column, bounds: list[int], low: int = 0) -> Column:
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    return F.when(key < bounds[mid], _bucket(key, bounds[:mid], low)).otherwise(_bucket(key, bounds[mid + 1 :], low + mid + 1))


def fingerprint_edits(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Every text's fingerprint, and those of its edited text and of the next document, compared.

    The next document has the next larger doc_id; the last one's next is the
    first. The edited text is the text whose last quarter of code points is
    replaced by the first as many (or all) of the next document. Rows with one
    doc_id follow each other by text; rows without doc_id come last. Null texts
    are empty. A single row is its own next. Other columns are ignored.

    Texts are dealt to ``buckets`` ranges of doc_id (the session's shuffle
    partitions unless given), found from the narrow column alone. Each bucket
    also gets the first document of the next one.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(doc_order().alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    quantiles = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(keyed.agg(F.percentile_approx("key", quantiles, 100 * buckets)).first()[0] or [])) if quantiles else []
    keyed = keyed.withColumn("bucket", _bucket(F.col("key"), bounds))
    firsts = sorted(keyed.groupBy("bucket").agg(F.min("key")).collect())  # a row a bucket
    ahead = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    ahead = F.broadcast(spark.createDataFrame(ahead, "key bigint, before int"))
    place = lambda b, a: F.struct(b.alias("bucket"), F.lit(a).alias("ahead"))
    both = F.when(F.col("before").isNull(), F.array(place(F.col("bucket"), False)))
    both = both.otherwise(F.array(place(F.col("bucket"), False), place(F.col("before"), True)))
    dealt = keyed.join(ahead, "key", "left").select("key", "doc_id", "text", F.explode(both).alias("at"))
    dealt = dealt.select("at.bucket", "at.ahead", "key", "doc_id", "text").repartition(buckets, "bucket")
    ordered = dealt.sortWithinPartitions("bucket", "ahead", "key", "text").select("bucket", "ahead", "doc_id", "text")
    return ordered.mapInArrow(_beside_next, _EDITED)
