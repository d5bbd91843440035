"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of passages with test items.

Word n-grams of the items go into a bitmap of bounded size. Documents are read
once and give only n-grams that the bitmap lets through; these are joined with
the items' n-grams exactly. All n-grams of an item are its seeds, however
common: those that a much repeated copy keeps are the common ones. A seed lays
the item over the document; the passage around it is aligned word by word, gaps
and exchanged words included, so edited and paraphrased copies score high.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korpusmill.llm.common import doc_order
from korpusmill.session import shared_folder, store

SEED_WORDS, MIN_SCORE = 3, 0.4
#: Items of fewer words must occur word for word; those of fewer than SEED_WORDS are no evidence.
SHORT_ITEM = 8
#: Bits of the bitmap: 64 an n-gram, up to 16 MB; beyond that more n-grams pass to the exact join.
MAX_BITMAP_BITS = 1 << 27
MATCH, OTHER, GAP = 2, -1, 1
_CELLS = 1 << 19

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c < 128 and not (48 <= c <= 57 or 97 <= c <= 122) else c for c in range(256)
)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words: runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    words = (text or "").encode().translate(_TABLE).split()
    return np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    x = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        x = (x ^ h[k : k + len(x)]) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    return x


def _spots(g: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return g & np.uint64(bits - 1), (g >> np.uint64(32)) & np.uint64(bits - 1)


def _item_grams(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"item_id": [], "hashes": [], "gram": []}
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = word_hashes(text.as_py())
                if len(h) >= n:
                    out["item_id"].append(item)
                    out["hashes"].append(h.tobytes())
                    out["gram"].append(grams(h, n).view(np.int64))
            yield pa.record_batch({
                "item_id": pa.array(out["item_id"], pa.int64()), "hashes": pa.array(out["hashes"], pa.binary()),
                "grams": pa.array(out["gram"], pa.list_(pa.int64())),
            })

    return run


def _possible_hits(n: int, bitmap, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bitmap.value
        for batch in batches:
            docs, spots, found = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                g = grams(word_hashes(text.as_py()), n)
                at = np.arange(len(g))
                for k in (0, 1):
                    s = _spots(g[at], bits)[k]
                    at = at[(words[s >> np.uint64(6)] >> (s & np.uint64(63))) & np.uint64(1) == 1]
                docs.append(np.full(len(at), doc, np.int64))
                spots.append(at)
                found.append(g[at].view(np.int64))
            if docs:
                yield pa.record_batch({"doc": np.concatenate(docs), "at": np.concatenate(spots), "gram": np.concatenate(found)})

    return run


def _bitmap(seeds: DataFrame, bits: int) -> np.ndarray:
    """The bitmap as 64-bit words, put together by Spark; at most ``MAX_BITMAP_BITS`` bits reach the driver."""
    g = F.col("gram")
    spots = seeds.select(F.explode(F.array(g.bitwiseAND(bits - 1), F.shiftrightunsigned(g, 32).bitwiseAND(bits - 1))).alias("s"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("s").bitwiseAND(63).cast("int"))
    rows = spots.groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(one).alias("v")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[rows["w"].to_numpy()] = rows["v"].to_numpy()
    return words.view(np.uint64)


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of each item with its passage: score, and position of the passage's last aligned word."""
    n, rows, cols = len(items), max(map(len, items)), max(1, max(map(len, passages)))
    item, passage = np.zeros((n, rows), np.uint64), np.ones((n, cols), np.uint64)
    for i, (x, y) in enumerate(zip(items, passages)):
        item[i, : len(x)], passage[i, : len(y)] = x | np.uint64(2), y | np.uint64(2)
    step = np.arange(cols, dtype=np.int32) * GAP
    h = np.zeros((n, cols + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for r in range(rows):
        e = h[:, :-1] + np.where(item[:, r, None] == passage, np.int32(MATCH), np.int32(OTHER))
        np.maximum(e, h[:, 1:] - GAP, out=e)
        np.maximum(e, 0, out=e)
        h[:, 1:] = np.maximum.accumulate(e + step, axis=1) - step
        at = h[:, 1:].argmax(axis=1)
        top = h[np.arange(n), at + 1]
        better = top > best
        best[better], end[better] = top[better], at[better]
    return best, end


def _spans(lays: list[int], slack: int) -> list[list[int]]:
    """First and last of neighbouring lays: passages no longer than ``slack`` more than one lay's, and none cut short by another's."""
    spans: list[list[int]] = []
    for lay in lays:
        if spans and lay - spans[-1][0] <= slack:
            spans[-1][1] = lay
        else:
            spans.append([lay, lay])
    return spans


def _aligned(n: int, min_score: float):
    def flush(todo: list[tuple]) -> pa.RecordBatch:
        scores, ends = align([t[2] for t in todo], [t[3] for t in todo]) if todo else ([], [])
        out = {"doc": [], "item_id": [], "score": [], "last_word": []}
        for (doc, item, x, y, first), s, e in zip(todo, scores, ends):
            score = float(s) / (MATCH * len(x))
            if score >= (min_score if len(x) >= SHORT_ITEM else 1.0):
                for name, v in zip(out, (doc, item, score, first + int(e))):
                    out[name].append(v)
        return pa.record_batch({"doc": pa.array(out["doc"], pa.int64()), "item_id": pa.array(out["item_id"], pa.int64()), "score": pa.array(out["score"], pa.float64()), "last_word": pa.array(out["last_word"], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        todo, cells = [], 0
        for batch in batches:
            for doc, text, tries in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                h = word_hashes(text.as_py())
                for t in tries.as_py():
                    x = np.frombuffer(t["hashes"], np.uint64)
                    slack = max(SHORT_ITEM, len(x) // 2)
                    for since, until in _spans(sorted(t["lays"]), slack):
                        first = max(0, since - slack)
                        y = h[first : max(first, until + len(x) + 2 * slack)]
                        if MATCH * np.isin(x, y).sum() >= min_score * MATCH * len(x):  # no alignment scores more
                            if todo and (cells + len(y) > _CELLS or len(x) * len(y) > 4 * len(todo[-1][2]) * len(todo[-1][3])):
                                yield flush(todo)
                                todo, cells = [], 0
                            todo.append((doc, t["item_id"], x, y, first))
                            cells += len(y)
        yield flush(todo)

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, n: int = SEED_WORDS, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc, item_id, score, last_word``: the best alignment of every document and test item that scores ``min_score`` or more.

    ``doc`` is the doc_id, or the largest bigint for documents without one,
    which count as one. Rows with one doc_id are one document, too. A score of
    1 is the whole item word for word; an exchanged word costs one and a half
    times a missing match. Null or empty texts and items match nothing. Other
    columns are ignored; empty tables give an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(doc_order().alias("doc"), "text")
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id IS NOT NULL").dropDuplicates()
    items = items.mapInArrow(_item_grams(n), "item_id bigint, hashes binary, grams array<bigint>")
    items = store(items.withColumn("item", F.xxhash64("item_id", "hashes")), shared_folder(spark, "items"))
    seeds = items.select("item", F.posexplode("grams").alias("offset", "gram"))

    size = int(items.agg(F.coalesce(F.sum(F.size("grams")), F.lit(0))).first()[0])
    bits = min(MAX_BITMAP_BITS, 1 << max(10, (64 * size).bit_length()))
    bitmap = spark.sparkContext.broadcast(_bitmap(seeds, bits))
    hits = texts.mapInArrow(_possible_hits(n, bitmap, bits), "doc bigint, at bigint, gram bigint")

    # A hot n-gram has many narrow rows here; they are one row a document and item before texts or items come near.
    lays = hits.join(seeds, "gram").select("doc", "item", (F.col("at") - F.col("offset")).alias("lay"))
    tries = lays.groupBy("doc", "item").agg(F.collect_set("lay").alias("lays")).join(items.select("item", "item_id", "hashes"), "item")
    tries = tries.groupBy("doc").agg(F.collect_list(F.struct("item_id", "hashes", "lays")).alias("tries"))
    found = texts.join(tries, "doc").select("doc", "text", "tries").mapInArrow(_aligned(n, min_score), "doc bigint, item_id bigint, score double, last_word bigint")
    return found.groupBy("doc", "item_id").agg(F.max("score").alias("score"), F.max_by("last_word", F.struct(F.col("score"), -F.col("last_word"))).alias("last_word"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a test item; all columns stay."""
    gone = leaks(docs, benchmark).select(F.col("doc").alias("_leaked")).distinct()
    return docs.join(gone, doc_order() == F.col("_leaked"), "left_anti")
