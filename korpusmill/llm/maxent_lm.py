"""Hashed maximum-entropy language model with a class-factored softmax.

log P(word | history) = log P(class | history) + log P(word | class). The class
is a softmax over the summed weights of hashed features of the history: the
last word, the last two, and a skip feature, the word before the last. The word
within its class is a softmax over word weights alone, whose best weights are
known: logarithms of counts.

Texts become shards once: token numbers, and the shard's distinct words as
hashes. Words alone travel to be counted, and the counts travel back, so a
frequent word costs one row a shard. The weights are trained by distributed
gradient updates: in each round tasks update copies of the weights on their
shards, and the updates are averaged row by row in a stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.session import shared_folder, store

SHARD_CHARS = 6_000_000
#: Words with numbers of their own, neighbours that describe them, and the classes these words are dealt to.
TOP_WORDS, NEIGHBOURS, CLUSTERS = 4096, 128, 28
#: The other classes: the end, words counted often, seldom, and up to RARE times (with all unknown words).
END_CLASS, OFTEN, SELDOM, RARELY = CLUSTERS, CLUSTERS + 1, CLUSTERS + 2, CLUSTERS + 3
CLASSES = CLUSTERS + 4
OFTEN_FROM, RARE, DISCOUNT = 100, 4, 0.5
ROWS, BLOCK, ROUNDS, BATCH, RATE = 1 << 15, 1 << 10, 2, 4096, 0.2
#: Shards of a task, and words of a shard, that a place (a bigint) can name.
SHARDS_OF_TASK = 1 << 12
#: No word has a blank in it, so this is the hash of the end of a text alone.
END = int(np.uint64(xxhash.xxh3_64_intdigest(b" ")).view(np.int64))


def held_out(doc_id: Column) -> Column:
    """Whether the text is never learned from; texts without doc_id are learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


# --- texts to shards
_SHARDS = "shard bigint, docs array<bigint>, held array<boolean>, lengths array<int>, tokens binary, hashes binary, counts binary"
_COUNTED = "shard bigint, docs array<bigint>, held array<boolean>, lengths array<int>, tokens binary, counts binary, tops binary"


def _planes(ids: np.ndarray) -> bytes:
    """Integers byte by byte, all first bytes first: early words have small numbers, so most planes pack well."""
    return ids.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.int32).ravel()


def _to_shards(size: int):
    def flush(shard, docs, held, lengths, tokens, words):
        hashes = np.array([xxhash.xxh3_64_intdigest(b" " if w is None else w) for w in words], np.uint64)
        ids = np.array(tokens, np.int32)
        learned = ~np.repeat(np.array(held, bool), lengths)
        counts = np.bincount(ids[learned], minlength=len(words)).astype(np.int32)
        return pa.record_batch({
            "shard": pa.array([shard], pa.int64()), "docs": pa.array([docs], pa.list_(pa.int64())), "held": pa.array([held], pa.list_(pa.bool_())),
            "lengths": pa.array([lengths], pa.list_(pa.int32())), "tokens": pa.array([_planes(ids)], pa.binary()),
            "hashes": pa.array([hashes.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chars = TaskContext.get().partitionId() * SHARDS_OF_TASK, 0
        docs, held, lengths, tokens, words = [], [], [], [], {None: 0}
        for batch in batches:
            for doc, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = (text.as_py() or "").encode().lower()  # bytes: A-Z and ASCII white space alone
                own = [words.setdefault(w, len(words)) for w in text.split()]
                docs.append(doc)
                held.append(out)
                lengths.append(len(own) + 1)
                tokens += own
                tokens.append(0)
                chars += len(text)
                if chars >= size:
                    yield flush(shard, docs, held, lengths, tokens, words)
                    shard, chars = shard + 1, 0
                    docs, held, lengths, tokens, words = [], [], [], [], {None: 0}
        if docs:
            yield flush(shard, docs, held, lengths, tokens, words)

    return run


def _shard_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, hashes, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            h = np.frombuffer(hashes.as_py(), np.int64)
            for at in range(0, len(h), 1 << 16):
                part = h[at : at + (1 << 16)]
                place = np.arange(at, at + len(part), dtype=np.int64) + (shard << 31)
                yield pa.record_batch({"place": place, "hash": part, "n": np.frombuffer(counts.as_py(), np.int32)[at : at + len(part)]})


def _with_counts(shard: pa.Table, counts: pa.Table) -> pa.Table:
    local, known = counts["local"].to_numpy(), counts["known"].to_numpy()
    c, tops = np.zeros(len(local), np.int64), np.full(len(local), -1, np.int16)
    c[local], tops[local] = known >> 16, (known & 0xFFFF) - 1
    return shard.append_column("counts", pa.array([c.tobytes()], pa.binary())).append_column("tops", pa.array([tops.tobytes()], pa.binary()))


def _packed(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One shard at a time, so that one alone is copied."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def to_shards(docs: DataFrame, shard_chars: int = SHARD_CHARS, top_words: int = TOP_WORDS) -> tuple[DataFrame, DataFrame, list]:
    """Shards with the counts of their words in all learned texts, these counts (hash, c), and the commonest words.

    A shard also has its words' numbers among the ``top_words`` commonest, -1 for others.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held"), "text")
    shards = _packed(texts.mapInArrow(_to_shards(shard_chars), _SHARDS), shared_folder(spark, "shards"))
    words = shards.select("shard", "hashes", "counts").mapInArrow(_shard_words, "place bigint, hash bigint, n int")
    counts = store(words.groupBy("hash").agg(F.sum("n").alias("c")), shared_folder(spark, "word-counts"))
    top = counts.where((F.col("c") > 0) & (F.col("hash") != END)).orderBy(F.desc("c"), "hash").limit(top_words).collect()
    numbers = spark.createDataFrame([(r["hash"], i) for i, r in enumerate(top)], "hash bigint, top smallint")
    # A count and a number share one bigint on their way back: 48 and 16 bits.
    both = F.shiftleft("c", 16) + F.coalesce("top", F.lit(-1)) + 1
    known = counts.join(F.broadcast(numbers), "hash", "left").select("hash", both.alias("known"))
    local = F.col("place").bitwiseAND((1 << 31) - 1).cast("int").alias("local")
    back = words.select("place", "hash").join(known, "hash").select(F.shiftright("place", 31).alias("shard"), local, "known")
    narrow = shards.drop("hashes", "counts")
    coded = narrow.groupBy("shard").cogroup(back.groupBy("shard")).applyInArrow(_with_counts, _COUNTED)
    return _packed(coded, shared_folder(spark, "counted-shards")), counts, top


# --- words and classes; broadcasts carry the fields alone, which need no installation to be read
@dataclass
class Words:
    """Classes of the commonest words by number, their counts, and totals by class."""

    top: np.ndarray
    classes: np.ndarray
    totals: np.ndarray
    rare_types: int
    tokens: int
    types: int

    def describe(self, tops: np.ndarray, counts: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct words: symbol in histories, class, and log P(word | class)."""
        cls = np.where(counts >= OFTEN_FROM, OFTEN, np.where(counts > RARE, SELDOM, RARELY))
        known = tops >= 0
        cls[known] = self.classes[tops[known]]
        cls[end] = END_CLASS
        symbol = np.where(known, tops.astype(np.int64), len(self.top) + cls - CLUSTERS)
        mass = counts - np.where(cls == RARELY, DISCOUNT, 0.0)
        if self.totals[RARELY] > 0:
            mass[(cls == RARELY) & (counts == 0)] = DISCOUNT * self.rare_types
        total = np.maximum(self.totals[cls], 1)
        mass[(cls == RARELY) & (counts == 0) & (self.totals[RARELY] == 0)] = 1
        mass[end] = total[end]
        return symbol, cls, np.log(np.maximum(mass, 1e-300) / total)


class _Shard:
    """A shard's tokens (numbers of its words), what is known of its words, and its documents' lengths and held-out marks."""

    def __init__(self, row: dict, words: Words):
        self.tokens, self.counts = _from_planes(row["tokens"]), np.frombuffer(row["counts"], np.int64)
        symbol, cls, self.inside = words.describe(np.frombuffer(row["tops"], np.int16), self.counts, np.arange(len(self.counts)) == 0)
        self.symbols, self.classes = symbol.astype(np.int32)[self.tokens], cls.astype(np.int8)
        self.lengths, self.held = np.array(row["lengths"], np.int64), np.array(row["held"], bool)

    def learned(self) -> np.ndarray:
        return ~np.repeat(self.held, self.lengths)


def _history(symbols: np.ndarray, lengths: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols one and two places before each token, ``start`` before a text's begin."""
    one, two = np.roll(symbols, 1), np.roll(symbols, 2)
    begins = np.cumsum(lengths) - lengths
    one[begins], two[begins] = start, start
    second = begins[lengths > 1] + 1
    two[second] = start
    return one, two


def feature_rows(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Rows of the weights for each token: last word, last two words, word before the last."""
    one, two = one.astype(np.uint64), two.astype(np.uint64)
    keys = np.stack([one << np.uint64(2), (one << np.uint64(34)) | (two << np.uint64(2)) | np.uint64(1), (two << np.uint64(2)) | np.uint64(2)], axis=1)
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((keys >> np.uint64(40)) % np.uint64(ROWS)).astype(np.int32)


def _neighbour_pairs(shared):
    """Counts of (word, side, neighbour) among learned tokens: words with numbers beside the commonest ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, common = Words(**shared.value[0]), shared.value[1]
        size = len(words.top) * 2 * NEIGHBOURS
        total = np.zeros(size, np.int64)
        for row in _rows(batches):
            shard = _Shard(row, words)
            symbol, learned = shard.symbols, shard.learned()
            seat = np.append(common, np.full(8, -1)).astype(np.int32)[symbol]  # place among the commonest, -1 for others
            for side, (a, b) in enumerate(((symbol[1:], seat[:-1]), (symbol[:-1], seat[1:]))):
                use = learned[1:] & learned[:-1] & (a < len(words.top)) & (b >= 0)
                total += np.bincount((a[use] * 2 + side) * NEIGHBOURS + b[use], minlength=size)
        at = np.flatnonzero(total)
        yield pa.record_batch({"pair": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    return run


def _cluster(vectors: np.ndarray, weights: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Weighted k-means from seeds far apart, always the same for the same words."""
    centres = [vectors[int(weights.argmax())]]
    far = ((vectors - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k:
        centres.append(vectors[int((far * np.sqrt(weights)).argmax())])
        far = np.minimum(far, ((vectors - centres[-1]) ** 2).sum(axis=1))
    centres = np.array(centres)
    for _ in range(rounds):
        own = ((centres**2).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)
        for j in range(k):
            mine = own == j
            if mine.any():
                centres[j] = np.average(vectors[mine], axis=0, weights=weights[mine])
    return own


def find_words(shards: DataFrame, counts: DataFrame, commonest: list) -> Words:
    """Totals, and classes of the commonest words from their neighbours, whose pairs are collected."""
    spark = shards.sparkSession
    seen = counts.where("c > 0")
    tokens, types = seen.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top, n = np.array([r["hash"] for r in commonest], np.int64), np.array([r["c"] for r in commonest], np.float64)
    words = Words(n, np.zeros(len(top), np.int64), np.zeros(CLASSES), 0, int(tokens), int(types))
    if len(top):
        common = np.full(len(top), -1)
        common[:NEIGHBOURS] = np.arange(min(NEIGHBOURS, len(top)))
        shared = spark.sparkContext.broadcast((vars(words), common))
        pairs = shards.mapInArrow(_neighbour_pairs(shared), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
        beside = np.zeros(len(top) * 2 * NEIGHBOURS)
        beside[pairs["pair"].to_numpy()] = pairs["n"].to_numpy()
        beside = np.sqrt(beside.reshape(len(top), -1) + 0.01)
        beside /= np.sqrt((beside**2).sum(axis=1, keepdims=True))
        words.classes = _cluster(beside, n, CLUSTERS).astype(np.int64)
        words.totals[:CLUSTERS] = np.bincount(words.classes, n, CLUSTERS)
    band = F.when(F.col("c") >= OFTEN_FROM, OFTEN).when(F.col("c") > RARE, SELDOM).otherwise(RARELY)
    own = spark.createDataFrame([(int(h),) for h in top], "hash bigint")
    rest = seen.where(F.col("hash") != END).join(F.broadcast(own), "hash", "left_anti").groupBy(band.alias("band")).agg(F.sum("c"), F.count("*")).collect()
    for cls, total, kinds in rest:
        words.totals[cls] = total
        words.rare_types = kinds if cls == RARELY else words.rare_types
    words.totals[END_CLASS] = tokens - words.totals.sum()
    return words


# --- class weights
@dataclass
class Weights:
    bias: np.ndarray
    table: np.ndarray

    def log_classes(self, rows: np.ndarray) -> np.ndarray:
        z = self.bias + self.table[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            z += self.table[rows[:, k]]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _updates(shared, rounds: int, number: int):
    """Changes of weights in blocks of rows, from gradient steps over the shards of this round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = Words(**shared.value[0]), Weights(**shared.value[1])
        local, squares, uses = Weights(weights.bias, weights.table.copy()), np.full(ROWS, 1e-2, np.float32), np.zeros(ROWS, np.int64)
        for row in _rows(batches):
            if row["shard"] * 0x9E3779B1 % (1 << 32) * rounds >> 32 != number:
                continue
            shard = _Shard(row, words)
            learned = np.flatnonzero(shard.learned())
            one, two = _history(shard.symbols, shard.lengths, len(words.top))
            for at in range(0, len(learned), BATCH):
                use = learned[at : at + BATCH]
                rows = feature_rows(one[use], two[use])
                slope = np.exp(local.log_classes(rows))
                slope[np.arange(len(use)), shard.classes[shard.tokens[use]]] -= 1
                flat = rows.ravel()
                order = np.argsort(flat, kind="stable")
                starts = np.flatnonzero(np.diff(flat[order], prepend=-1))
                touched = flat[order[starts]]
                n = np.diff(starts, append=len(flat))
                sums = np.add.reduceat(slope[order // rows.shape[1]], starts)
                uses[touched] += n
                squares[touched] += (sums * sums).mean(axis=1)
                local.table[touched] -= np.float32(RATE) * sums / np.sqrt(squares[touched])[:, None]
        change = local.table - weights.table
        for block in range(ROWS // BLOCK):
            own = slice(block * BLOCK, (block + 1) * BLOCK)
            if uses[own].any():
                weighted = (change[own] * uses[own, None]).astype(np.float32)
                yield pa.record_batch({"block": pa.array([block], pa.int32()), "uses": [uses[own].tobytes()], "change": [weighted.tobytes()]})

    return run


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by block in a stream: memory follows the number of blocks, not of tasks."""
    total: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for block, uses, change in zip(*(c.to_pylist() for c in batch.columns)):
            one = [np.frombuffer(uses, np.int64), np.frombuffer(change, np.float32).astype(np.float64)]
            total[block] = [a + b for a, b in zip(total[block], one)] if block in total else one
    for block, (uses, change) in total.items():
        mean = change.reshape(BLOCK, CLASSES) / np.maximum(uses, 1)[:, None]
        yield pa.record_batch({"block": pa.array([block], pa.int32()), "change": [mean.astype(np.float32).tobytes()]})


def train(shards: DataFrame, words: Words, rounds: int = ROUNDS) -> Weights:
    """Every learned token takes part in one of ``rounds`` rounds; the table of weights (4 MB) passes through the driver."""
    prior = words.totals + 1
    weights = Weights(np.log(prior / prior.sum()).astype(np.float32), np.zeros((ROWS, CLASSES), np.float32))
    for number in range(rounds):
        shared = shards.sparkSession.sparkContext.broadcast((vars(words), vars(weights)))
        changes = shards.mapInArrow(_updates(shared, rounds, number), "block int, uses binary, change binary")
        summed = changes.repartition(8, "block").mapInArrow(_sum_blocks, "block int, change binary").collect()
        table = weights.table.copy()
        for block, change in summed:
            table[block * BLOCK : (block + 1) * BLOCK] += np.frombuffer(change, np.float32).reshape(BLOCK, CLASSES)
        weights = Weights(weights.bias, table)
    return weights


# --- scores
_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = Words(**shared.value[0]), Weights(**shared.value[1])
        for row in _rows(batches):
            shard = _Shard(row, words)
            one, two = _history(shard.symbols, shard.lengths, len(words.top))
            logs = np.empty(len(shard.tokens))
            for at in range(0, len(logs), 1 << 14):
                part = slice(at, at + (1 << 14))
                token = shard.tokens[part]
                own = weights.log_classes(feature_rows(one[part], two[part]))
                logs[part] = shard.inside[token] + own[np.arange(len(own)), shard.classes[token]]
            lengths = shard.lengths
            begins = np.cumsum(lengths) - lengths
            base = (np.log10(shard.counts + 1.0) - np.log10(words.tokens + words.types + 1.0))[shard.tokens]
            known = np.add.reduceat(shard.counts[shard.tokens] > 0, begins, dtype=np.int64)
            yield pa.record_batch({
                "doc_id": pa.array(row["docs"], pa.int64()), "held_out": pa.array(shard.held), "n_tokens": pa.array(lengths, pa.int64()),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(lengths), words.tokens, np.int64)),
                "base_score": pa.array(np.add.reduceat(base, begins)), "score": pa.array(np.add.reduceat(logs, begins) / np.log(10)),
            })

    return run


def score_texts(docs: DataFrame, rounds: int = ROUNDS, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Log10 probability of every text of ``docs`` (doc_id, text) under the model and under smoothed word counts.

    Both learn from the texts that are not held out. Tokens are the words
    between ASCII white space, A-Z lower-cased, and an end; null and empty
    texts are the end alone. All unknown words are one word. Rows count as
    often as they occur, rows without doc_id are learned from. Other columns
    are ignored, and an empty table gives an empty result.
    """
    shards, counts, commonest = to_shards(docs, shard_chars)
    words = find_words(shards, counts, commonest)
    shared = docs.sparkSession.sparkContext.broadcast((vars(words), vars(train(shards, words, rounds))))
    return shards.mapInArrow(_scores(shared), _SCORES)
