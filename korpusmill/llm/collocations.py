"""Phrase collocations by multikey three-way quicksort of suffix pointers.

Every word of a text is a suffix: itself and the words after it in its piece,
to the depth of the longest phrase. Suffixes are routed to shards by their
leading words: by the first one; by the first two where too many suffixes share
that one; by all where too many share two. In a shard a multikey quicksort
parts the pointers in three by the word at the current depth (less than, equal
to, greater than a pivot), all open partitions of a shard in step. A partition
of equals is a phrase and its size the phrase's count; it is parted further by
the next word. Partitions that hold fewer pointers than a candidate needs are
abandoned, unless their phrase is spread over shards.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korpusmill.session import shared_folder, store

DEPTH, MIN_COUNT, TOP, UNKNOWN_LANG = 3, 10, 2000, "und"
#: A longer candidate with this share (per cent) of a shorter one's count takes it in.
ABSORBED_PERCENT, SCALE = 50, 1_000_000
#: Words a task gathers before it deals them out, suffixes of a shard on average, and suffixes of one leading key from
#: which on the next word routes, too.
BLOCK_WORDS, SHARD_SUFFIXES, HOT_SUFFIXES = 1 << 19, 1 << 20, 1 << 19
_CHARS_A_WORD = 6
_BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")


def pieces(text: str | None) -> list[list[bytes]]:
    """Words of each piece; A-Z in lower case."""
    return [p.split() for p in (text or "").encode().lower().translate(_BREAKS).split(b"\n")]


# --- texts to suffixes
class _Block:
    """Word numbers of some texts of one language; 0 ends a piece."""

    def __init__(self, lang: str):
        self.lang, self.hash = lang, np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        self.numbers = defaultdict(count(1).__next__)
        self.tokens: list[int] = []

    def add(self, text: str | None) -> None:
        for words in pieces(text):
            if words:
                self.tokens += map(self.numbers.__getitem__, words)
                self.tokens.append(0)

    def suffixes(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct suffixes (a row of ``depth`` word numbers, 0 after the piece's end) and how often each occurs."""
        t = np.array(self.tokens + [0] * depth, np.int64)
        at = np.flatnonzero(t[: len(t) - depth])
        rows = np.zeros((depth, len(at)), np.int64)
        rows[0] = t[at]
        for k in range(1, depth):
            rows[k] = np.where(rows[k - 1] > 0, t[at + k], 0)
        order = np.lexsort(rows[::-1])
        rows = rows[:, order]
        first = np.concatenate(([True], (rows[:, 1:] != rows[:, :-1]).any(axis=0))) if len(at) else np.zeros(0, bool)
        starts = np.flatnonzero(first)
        return rows[:, starts], np.diff(np.append(starts, len(at)))

    def keys(self, rows: np.ndarray) -> list[np.ndarray]:
        """A 64-bit hash of the language and the first k words, for each k."""
        words = np.array([0] + [xxhash.xxh3_64_intdigest(w) for w in self.numbers], np.uint64)
        key, keys = np.full(rows.shape[1], self.hash), []
        for row in rows:
            key = (key ^ words[row]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
            keys.append(key)
        return keys


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    held, words = {}, 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if lang not in held:
                held[lang] = _Block(lang)
            before = len(held[lang].tokens)
            held[lang].add(text.as_py())
            words += len(held[lang].tokens) - before
            if words >= BLOCK_WORDS:
                yield from held.values()
                held, words = {}, 0
    yield from held.values()


def _weigh(depth: int, bits: int):
    """Suffixes by bucket of their leading words' hash, for each number of leading words but the last, and words by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, langs = np.zeros((depth - 1, 1 << bits), np.int64), defaultdict(int)
        for block in _blocks(batches):
            rows, counts = block.suffixes(depth)
            langs[block.lang] += int(counts.sum())
            for k, key in enumerate(block.keys(rows)[:-1]):
                sums[k] += np.bincount((key >> np.uint64(64 - bits)).astype(np.int64), counts, 1 << bits).astype(np.int64)
        for k, row in enumerate(sums):
            bucket = np.flatnonzero(row)
            yield pa.record_batch({"kind": pa.array(np.full(len(bucket), k, np.int32)), "bucket": bucket, "lang": pa.nulls(len(bucket), pa.string()), "n": row[bucket]})
        yield pa.record_batch({"kind": pa.array([-1] * len(langs), pa.int32()), "bucket": pa.array([0] * len(langs), pa.int64()), "lang": pa.array(list(langs), pa.string()), "n": pa.array(list(langs.values()), pa.int64())})

    return run


def _packed(x: np.ndarray) -> bytes:
    """Numbers below 2^32 as byte planes, zstandard."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _deal(depth: int, bits: int, shards: int, hot: np.ndarray):
    """Rows for each shard: a block's suffixes with the words that they hold. ``spread``: leading words whose phrases other shards count, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            rows, counts = block.suffixes(depth)
            keys = block.keys(rows)
            route, spread = keys[0], np.zeros(len(counts), np.int64)
            for k in range(1, depth):
                more = hot[k - 1][(keys[k - 1] >> np.uint64(64 - bits)).astype(np.int64)] & (spread == k - 1)
                route, spread = np.where(more, keys[k], route), np.where(more, k, spread)
            shard = (route & np.uint64(0xFFFFFFFF)).astype(np.int64) % shards
            order = np.argsort(shard, kind="stable")
            bounds = np.flatnonzero(np.diff(shard[order])) + 1
            words, out = [b"", *block.numbers], []
            for part in np.split(order, bounds) if len(order) else []:
                own, local = np.unique(rows[:, part], return_inverse=True)
                local = local.reshape(depth, -1) + (own[0] != 0)  # 0 stays the piece's end
                text = b"\n".join(words[w] for w in own[own > 0])  # no word holds a line feed
                numbers = np.concatenate([local.ravel(), spread[part], counts[part]])
                out.append((int(shard[part[0]]), zstandard.ZstdCompressor(level=1).compress(text), _packed(numbers)))
            for at in range(0, len(out), 64):
                some = list(zip(*out[at : at + 64]))
                yield pa.record_batch({
                    "shard": pa.array(some[0], pa.int64()), "lang": pa.array([block.lang] * len(some[0]), pa.string()),
                    "words": pa.array(some[1], pa.binary()), "numbers": pa.array(some[2], pa.binary()),
                })

    return run


# --- counting in a shard
def sort_suffixes(rows: np.ndarray, weights: np.ndarray, spread: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each depth, a pointer to a suffix that begins with a phrase, and the phrase's count.

    ``rows``: word numbers, a row a depth, 0 after the end. ``weights``: how
    often each suffix occurs; partitions are weighed by their sums. Phrases of
    fewer than ``least`` occurrences are abandoned with all that begin with
    them, except those of up to ``spread`` words, whose count goes on elsewhere.
    """
    depth, found = len(rows), []
    # Pointers of open partitions, side by side; ``part`` numbers the partitions, all of one depth.
    pointers, part = np.flatnonzero(rows[0] > 0), None
    part = np.zeros(len(pointers), np.int64)
    for d in range(depth):
        heads, sums, nexts, next_parts, made = [], [], [], [], 0
        while len(pointers):
            key = rows[d][pointers]
            begins = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            sizes = np.diff(np.append(begins, len(pointers)))
            # The pivot: the middle one of the first, middle and last pointer's words.
            a, b, c = key[begins], key[begins + sizes // 2], key[begins + sizes - 1]
            pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
            run = np.repeat(np.arange(len(begins)), sizes)
            side = np.sign(key - pivot[run]) + 1  # less than, equal, greater
            # Three-way parting of every partition at once: each pointer's place among those of its side.
            place = np.empty(len(pointers), np.int64)
            per = np.zeros((len(begins), 3), np.int64)
            for s in range(3):
                on = side == s
                seen = np.cumsum(on)
                base = seen[begins] - on[begins]
                per[:, s] = np.append(base[1:], seen[-1]) - base
                place[on] = (seen - 1 - base[run])[on]
            offset = begins[:, None] + np.concatenate([np.zeros((len(begins), 1), np.int64), np.cumsum(per, axis=1)[:, :2]], axis=1)
            target = offset[run, side] + place
            moved, label = np.empty_like(pointers), np.empty_like(pointers)
            moved[target], label[target] = pointers, run * 3 + side
            starts = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
            lengths = np.diff(np.append(starts, len(moved)))
            total = np.add.reduceat(weights[moved], starts)
            held = np.maximum.reduceat(spread[moved], starts) > d
            equal = label[starts] % 3 == 1
            keep = (total >= least) | held
            done = equal & keep
            heads.append(moved[starts[done]])
            sums.append(total[done])
            if d + 1 < depth:  # a partition of equals goes on with the next word
                on = np.repeat(done, lengths) & (rows[min(d + 1, depth - 1)][moved] > 0)
                nexts.append(moved[on])
                next_parts.append(np.repeat(made + np.arange(len(starts)), lengths)[on])
                made += len(starts)
            open_ = np.repeat(~equal & keep, lengths)
            pointers, part = moved[open_], label[open_]
        found.append((np.concatenate(heads) if heads else np.zeros(0, np.int64), np.concatenate(sums) if sums else np.zeros(0, np.int64)))
        pointers, part = (np.concatenate(nexts), np.concatenate(next_parts)) if nexts else (np.zeros(0, np.int64),) * 2
    return found


def _count(depth: int, least: int):
    def run(table: pa.Table) -> pa.Table:
        numbers, langs, parts = defaultdict(count(1).__next__), {}, []
        for lang, words, packed in zip(table["lang"].to_pylist(), table["words"], table["numbers"]):
            text = zstandard.ZstdDecompressor().decompress(words.as_py())
            # Equal words are equal numbers in the whole shard; a leading word's number holds its language, too.
            own = np.array([0, *map(numbers.__getitem__, text.split(b"\n"))], np.int64) if text else np.zeros(1, np.int64)
            x = _unpacked(packed.as_py()).reshape(depth + 2, -1)
            x[:depth] = own[x[:depth]]
            x[0] += langs.setdefault(lang, len(langs)) << 40
            parts.append(x)
        x = np.concatenate(parts, axis=1)
        rows, spread, weights = x[:depth], x[depth], x[depth + 1]
        words, names, out = [None, *(w.decode() for w in numbers)], list(langs), []
        for d, (at, n) in enumerate(sort_suffixes(rows, weights, spread, least)):
            columns = {"lang": pa.array([names[i] for i in rows[0][at] >> 40], pa.string())}
            for k in range(depth):
                texts = [words[i] for i in rows[k][at] & ((1 << 40) - 1)] if k <= d else [None] * len(at)
                columns[f"w{k + 1}"] = pa.array(texts, pa.string())
            out.append(pa.table(columns | {"n": pa.array(n, pa.int64())}))
        return pa.concat_tables(out)

    return run


def phrase_counts(docs: DataFrame, depth: int = DEPTH, least: int = MIN_COUNT, shard_suffixes: int = SHARD_SUFFIXES, hot_suffixes: int = HOT_SUFFIXES) -> tuple[DataFrame, DataFrame]:
    """``lang, w1 .. w{depth}, f`` of all phrases of up to ``depth`` words with ``least`` occurrences or more, and ``lang, n`` of all languages.

    Words after a phrase's last one are null. Languages of null count as "und".
    Both are stored tables.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), "text")
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-chars // (_CHARS_A_WORD * shard_suffixes)))
    bits = min(20, max(10, (4 * shards).bit_length()))
    weights = texts.mapInArrow(_weigh(depth, bits), "kind int, bucket bigint, lang string, n bigint")
    weights = store(weights.groupBy("kind", "bucket", "lang").agg(F.sum("n").alias("n")), shared_folder(spark, "phrase-weights"))
    hot = np.zeros((depth - 1, 1 << bits), bool)  # 2^20 buckets at most
    for kind, bucket in weights.where(F.col("kind") >= 0).where(F.col("n") > hot_suffixes).select("kind", "bucket").collect():
        hot[kind, bucket] = True
    dealt = texts.mapInArrow(_deal(depth, bits, shards, hot), "shard bigint, lang string, words binary, numbers binary")
    names = [f"w{k + 1}" for k in range(depth)]
    schema = "lang string, " + ", ".join(f"{w} string" for w in names) + ", n bigint"
    counted = dealt.groupBy("shard").applyInArrow(_count(depth, least), schema)
    total = counted.groupBy("lang", *names).agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return store(total, shared_folder(spark, "phrase-counts")), weights.where("kind < 0").select("lang", "n")


# --- scores
def _first(counts: DataFrame, k: int, names: list[str], as_: str) -> DataFrame:
    """Counts of phrases of k words, the words named ``names``."""
    own = [f"w{i + 1}" for i in range(k)]
    rest = [c for c in counts.columns if c.startswith("w") and c not in own]
    exact = counts.where(F.col(own[-1]).isNotNull())
    if rest:
        exact = exact.where(F.col(rest[0]).isNull())
    return exact.select("lang", *(F.col(o).alias(n) for o, n in zip(own, names)), F.col("f").alias(as_))


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(SCALE * a * a / (l * r)), exact to 38 digits."""
    wide = [x.cast("decimal(38,0)") for x in (a, l, r)]
    return F.call_function("div", F.lit(SCALE).cast("decimal(38,0)") * wide[0] * wide[0], wide[1] * wide[2]).cast("bigint")


def score_phrases(counts: DataFrame, depth: int = DEPTH, least: int = MIN_COUNT, percent: int = ABSORBED_PERCENT) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that no longer candidate takes in."""
    names = [f"w{k + 1}" for k in range(depth)]
    every = None
    for size in range(2, depth + 1):
        own = names[:size]
        found = _first(counts, size, own, "a").where(F.col("a") >= least)
        cuts = []
        for k in range(1, size):
            found = found.join(_first(counts, k, own[:k], f"l{k}"), ["lang", *own[:k]]).join(_first(counts, size - k, own[k:], f"r{k}"), ["lang", *own[k:]])
            score = _score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}"))
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        found = found.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0])
        if size < depth:
            over = None
            for longer in range(size + 1, depth + 1):
                rows = _first(counts, longer, names[:longer], "b").where(F.col("b") >= least)
                spans = F.array(*(F.struct(*(F.col(names[i + j]).alias(own[j]) for j in range(size))) for i in range(longer - size + 1)))
                rows = rows.select("lang", F.explode(spans).alias("s"), "b").select("lang", "s.*", "b")
                over = rows if over is None else over.unionByName(rows)
            over = over.groupBy("lang", *own).agg(F.max("b").alias("b"))
            found = found.join(over, ["lang", *own], "left").where(F.expr(f"b is null or 100 * b < {int(percent)} * a"))
        found = found.select("lang", F.concat_ws(" ", *own).alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
        every = found if every is None else every.unionByName(found)
    return every


def collocations(
    docs: DataFrame, depth: int = DEPTH, least: int = MIN_COUNT, top: int = TOP, shard_suffixes: int = SHARD_SUFFIXES, hot_suffixes: int = HOT_SUFFIXES
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to ``depth`` words.

    Texts are cut at ``.,;:!?``, line feeds and the like; phrases lie within a
    piece. ``a`` is a phrase's count (``least`` or more), ``l`` and ``r`` those
    of its two parts at the lowest-scoring cut, ``n`` the language's words.
    Counts cover all documents. Null texts are empty, null languages "und".
    Ties go by count, then by the phrase's bytes. Repeated documents count each
    time. Other columns are ignored; an empty table gives no row.
    """
    spark = docs.sparkSession
    counts, langs = phrase_counts(docs, depth, least, shard_suffixes, hot_suffixes)
    scored = store(score_phrases(counts, depth, least), shared_folder(spark, "phrases"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the top of each of 64 parts of a language, then of the language.
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    near = scored.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(langs, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
