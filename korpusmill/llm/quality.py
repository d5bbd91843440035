"""Quality classifier: a factorisation machine over hashed words, structure statistics and length.

The pairwise part of the score, the sum of <v_i, v_j> x_i x_j over all pairs of
features, is half the difference between the square of the sum of v_i x_i and
the sum of the squares, so it takes time linear in a text's features.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.llm.common import with_fields

#: Labelled rows that the model is fitted on at most, those with the smallest hashes of their doc_id.
MAX_TRAINING_ROWS = 20_000
#: Small sets are gone through more often, for at least STEPS batches.
BUCKETS, FACTORS, EPOCHS, BATCH, STEPS = 1 << 14, 8, 8, 256, 500
THRESHOLD = 0.3
_MARKS = string.punctuation.encode()
_BINS = 12
#: Features by number: a share for each punctuation mark, five other shares, bins of six statistics, then hashed words.
_SHARES = len(_MARKS) + 5
_WORDS_FROM = _SHARES + 6 * _BINS


def held_out(doc_id: Column) -> Column:
    """Whether the row is never learned from; rows without doc_id are not held out (nor labelled)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of a text's features. Whole texts count; an empty text has only its length's bin."""
    text = text or ""
    raw = text.encode()
    size = max(1, len(raw))
    without = lambda chars: len(raw) - len(raw.translate(None, chars))
    words = text.split()
    counts = Counter(words)
    n, lines = max(1, len(words)), text.split("\n")
    caps, digits = without(string.ascii_uppercase.encode()), without(string.digits.encode())
    shares = [raw.count(m) / size for m in _MARKS]
    shares += [caps / size, digits / size, without(string.whitespace.encode()) / size, len(lines) / size, (len(raw) - len(text)) / size]
    top = max(counts.values(), default=0) / n
    stats = (len(counts) / n, top, 2 * caps / size, min(1.0, len(raw) / n / 24), 1 - len(set(lines)) / len(lines), min(1.0, len(text).bit_length() / 20))
    bins = [_SHARES + i * _BINS + min(_BINS - 1, int(s * _BINS)) for i, s in enumerate(stats)]
    hashed = [_WORDS_FROM + zlib.crc32(w.lower().encode()) % (BUCKETS - _WORDS_FROM) for w in counts]
    ids = np.array([*range(_SHARES), *bins, *hashed], np.int32)
    values = np.concatenate([np.sqrt(shares) * 2, np.ones(len(bins)), np.full(len(hashed), 1 / np.sqrt(max(1, len(hashed))))])
    return ids, values.astype(np.float32)


@dataclass
class Machine:
    """Bias, weights and factors; ``score`` gives probabilities of label 1."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of rows whose features begin at ``starts``, and each row's sums of factors."""
        vx = self.factors[ids] * values[:, None]
        sums = np.add.reduceat(vx, starts)
        squares = np.add.reduceat((vx * vx).sum(axis=1), starts)
        return self.bias + np.add.reduceat(self.weights[ids] * values, starts) + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def score(self, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(ids, values, starts)[0].astype(np.float64), -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.08, decay: float = 2e-5) -> Machine:
    """Logistic loss, batches in a fixed random order, step sizes by the squares of past gradients.

    Without rows the score is 0.5 for every text; with one label it stays near that label.
    """
    rng = np.random.default_rng(7)
    prior = (labels.sum() + 1) / (len(labels) + 2)
    machine = Machine(float(np.log(prior / (1 - prior))), np.zeros(BUCKETS, np.float32), rng.normal(0, 0.02, (BUCKETS, FACTORS)).astype(np.float32))
    seen_w, seen_v, seen_b = np.full(BUCKETS, 1e-3, np.float32), np.full((BUCKETS, FACTORS), 1e-3, np.float32), 1e-3
    for _ in range(max(epochs, -(-STEPS // -(-len(rows) // BATCH))) if rows else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            ids, values = (np.concatenate([rows[i][k] for i in batch]) for k in (0, 1))
            sizes = np.array([len(rows[i][0]) for i in batch])
            raw, sums = machine.raw(ids, values, np.cumsum(sizes) - sizes)
            slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]).astype(np.float32) / np.float32(len(batch))
            of = np.repeat(np.arange(len(batch)), sizes)
            gx = slope[of] * values
            gw = np.bincount(ids, gx, BUCKETS).astype(np.float32) + np.float32(decay) * machine.weights
            # The slope of the pairwise part for v_i is x_i * (sum of v_j x_j) - v_i * x_i ** 2.
            gv = np.stack([np.bincount(ids, gx * sums[of, f], BUCKETS) for f in range(FACTORS)], axis=1).astype(np.float32)
            gv -= np.bincount(ids, gx * values, BUCKETS).astype(np.float32)[:, None] * machine.factors
            gv += np.float32(decay) * machine.factors
            seen_w += gw * gw
            seen_v += gv * gv
            seen_b += float(slope.sum()) ** 2
            machine.weights -= np.float32(rate) * gw / np.sqrt(seen_w)
            machine.factors -= np.float32(rate / 2) * gv / np.sqrt(seen_v)
            machine.bias -= rate * float(slope.sum()) / seen_b**0.5
    return machine


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t.as_py()) for t in batch.column(1)]
        yield pa.record_batch({
            "key": batch.column(0), "label": batch.column(2),
            "ids": pa.array([i.tobytes() for i, _ in found], pa.binary()), "xs": pa.array([x.tobytes() for _, x in found], pa.binary()),
        })


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """``key, text, label`` of at most ``max_rows`` labelled rows that are not held out, by the hash of their doc_id.

    ``labels`` has doc_id and quality (0 or 1); rows without either are ignored.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").cast("bigint").alias("key"), F.col("quality").cast("int").alias("label")).distinct()
    chosen = known.orderBy(F.xxhash64("key"), "key", "label").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("key"), "text").join(F.broadcast(chosen), "key")
    return rows.groupBy("key", "label").agg(F.min("text").alias("text")).select("key", "text", "label")  # however often a doc_id occurs


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((k, label, i, x) for b in batches for k, label, i, x in zip(*(c.to_pylist() for c in b.columns)))
    pairs = [(np.frombuffer(i, np.int32), np.frombuffer(x, np.float32)) for _, _, i, x in rows]
    machine = fit(pairs, np.array([label for _, label, _, _ in rows], np.float64))
    yield pa.record_batch({"bias": [machine.bias], "weights": [machine.weights.tobytes()], "factors": [machine.factors.tobytes()]})


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Machine:
    """A machine fitted on ``training_rows``.

    Tasks make the features; one task fits the bounded sample, and the weights
    alone, half a megabyte, reach the driver.
    """
    made = training_rows(docs, labels, max_rows).mapInArrow(_featured, "key bigint, label int, ids binary, xs binary")
    row = made.repartition(1).mapInArrow(_fitted, "bias double, weights binary, factors binary").first()
    return Machine(row["bias"], np.frombuffer(row["weights"], np.float32), np.frombuffer(row["factors"], np.float32).reshape(-1, FACTORS))


def score_quality(docs: DataFrame, machine: Machine, column: str = "score") -> DataFrame:
    """``docs`` with the machine's probability of label 1 as ``column`` (a column of that name is replaced).

    Reads the text alone. Null and empty texts get a score like any other; repeated rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(machine))  # fields alone need no installation to be read

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Machine(**shared.value)
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 512):
                batch = whole.slice(at, 512)
                found = [features(t.as_py()) for t in batch.column(batch.schema.names.index("text"))]
                scores = np.empty(0)
                if found:
                    sizes = np.array([len(i) for i, _ in found])
                    scores = model.score(np.concatenate([i for i, _ in found]), np.concatenate([x for _, x in found]), np.cumsum(sizes) - sizes)
                kept = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != column}
                yield pa.RecordBatch.from_pydict(kept | {column: pa.array(scores, pa.float64())})

    return docs.mapInArrow(run, with_fields(docs, f"`{column}` double"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents whose score is below ``threshold``; all columns stay."""
    scored = score_quality(docs, train(docs, labels), "_quality_score")
    return scored.where(F.col("_quality_score") >= threshold).select(*docs.columns)
