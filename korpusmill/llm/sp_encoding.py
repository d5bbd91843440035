"""Encoding and decoding with a public merge-type SentencePiece vocabulary, with seeded merge-dropout.

All words of a batch are merged in step. A word's agenda is the row of ranks of
its neighbouring symbols; each step pops the best candidate of every agenda. A
hash of the document, the word's place in it and the candidate's turn decides
whether it is skipped; if not, its symbols become one. So each occurrence of a
word has skips of its own; one whose skips are those of another occurrence has
its pieces, too, and they are remembered. Long words, such as texts without a
blank, take the same turns one word at a time, with a heap as the agenda and
linked symbols. Skipping varies the segmentation, never the text: the pieces of any
segmentation decode to it, white space and unknown characters included.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korpusmill.llm.common import with_fields

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 1
#: Words whose undropped segmentations a task remembers; when there are more it forgets all.
REMEMBERED = 300_000
#: Words of more characters have a heap of their own: a row of ranks costs its length a turn, a heap the logarithm.
LONG = 1024
_NEVER = np.int32(2**31 - 1)
_EMPTY = np.uint64(2**64 - 1)
#: Pieces begin at spaces and none crosses a line break, so words are encoded each for itself.
_SEGMENTS = re.compile(r"\n| *[^ \n]+| +")


@dataclass
class Pieces:
    """The vocabulary: texts of normal pieces (None for others), their scores, and the byte pieces' ids."""

    texts: list[str | None]
    scores: list[float]
    bytes: list[int]


def load_pieces(model: str = MODEL) -> Pieces:
    """Read the vocabulary on the driver; tasks get it as a broadcast of some hundred kilobytes."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    ids = range(sp.get_piece_size())
    other = {i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)}
    texts = [None if i in other else sp.id_to_piece(i) for i in ids]
    by_byte = {sp.id_to_piece(i): i for i in ids if sp.is_byte(i)}
    return Pieces(texts, [sp.get_score(i) for i in ids], [by_byte[f"<0x{b:02X}>"] for b in range(256)])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Encoder:
    """Encodes and decodes whole texts. ``key`` makes documents differ; equal keys, seeds and texts give equal pieces."""

    def __init__(self, pieces: Pieces, dropout: float = DROPOUT, seed: int = SEED):
        self.dropout, self.seed = dropout, seed
        self.least = np.uint64(min(2**64 - 1, int(dropout * 2.0**64)))
        self.bytes = pieces.bytes
        known = {t: i for i, t in enumerate(pieces.texts) if t is not None}
        # The mark for a space stands for nothing else: in a text it is spelt in bytes, like all unknown characters.
        self.symbol = np.full(0x110000, -1, np.int32)
        for t, i in known.items():
            if len(t) == 1 and t != "▁":
                self.symbol[ord(t)] = i
        self.symbol[ord(" ")] = known["▁"]
        self.by_rank = np.argsort(-np.array(pieces.scores), kind="stable").astype(np.int32)
        rank = np.empty(len(self.by_rank), np.int32)
        rank[self.by_rank] = np.arange(len(rank), dtype=np.int32)
        pairs = [(known[t[:k]], known[t[k:]], rank[i]) for t, i in known.items() for k in range(1, len(t)) if t[:k] in known and t[k:] in known]
        self._fill_table(*(np.array(c, np.int64) for c in zip(*pairs)))
        self.rank_of: dict[int, int] = {}  # the same table for single pairs, filled with the first long word
        self.decoded = [b"" if t is None else t.replace("▁", " ").encode() for t in pieces.texts]
        for b, i in enumerate(pieces.bytes):
            self.decoded[i] = bytes([b])
        self._forget()

    def _forget(self) -> None:
        """Numbers of words; by number, pieces and candidates without skips, and a bound of candidates; pieces by number and skips."""
        self.numbers: dict[str, int] = {}
        self.plain: list[bytes] = []
        self.turns, self.bounds = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.varied: dict[tuple[int, int], bytes] = {}

    def _fill_table(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> None:
        """A sparse table from pairs of symbols to the rank of the piece they make; a taken slot passes on to the next."""
        bits = (16 * len(left)).bit_length()
        self.shift, keys = np.uint64(64 - bits), left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        self.keys, self.ranks = np.full((1 << bits) + 64, _EMPTY), np.full((1 << bits) + 64, _NEVER)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == _EMPTY]
            _, first = np.unique(slot[free], return_index=True)
            self.keys[slot[free[first]]], self.ranks[slot[free[first]]] = keys[free[first]], rank[free[first]]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pieces that pairs of symbols make; symbols below 0 make none."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64) & np.uint64(0xFFFFFFFF)
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.ranks[slot], _NEVER)
        todo = np.flatnonzero((seen != keys) & (seen != _EMPTY))
        while len(todo):
            slot[todo] += 1
            seen = self.keys[slot[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (seen != _EMPTY)]
        return out

    def _skipped(self, salts: np.ndarray, turn: int) -> np.ndarray:
        return (_mix(salts ^ np.uint64(turn)) < self.least) | (self.dropout >= 1)

    def _merge(self, words: list[str], salts: np.ndarray | None) -> tuple[list[bytes], np.ndarray]:
        """Piece ids of words of about one length, as bytes, and the numbers of their candidates; without salts none is skipped."""
        sizes = np.array(list(map(len, words)))
        n, width = len(words), int(sizes.max())
        inside = np.arange(width) < sizes[:, None]
        ids = np.full((n, width + 1), -2, np.int32)  # the last column stays empty
        ids[:, :width][inside] = self.symbol[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        final, rows = ids.copy(), np.arange(n)
        ranks = np.full((n, width + 1), _NEVER, np.int32)
        if width > 1:
            ranks[:, : width - 1] = self._pair_ranks(ids[:, : width - 1].ravel(), ids[:, 1:width].ravel()).reshape(n, width - 1)
        column, step = np.arange(width + 1), 0
        turns = np.zeros(n, np.int64)
        while len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            alive = best != _NEVER
            if alive.sum() <= 0.7 * len(rows):
                final[rows[~alive]] = ids[~alive]
                ids, ranks, rows, at, best = ids[alive], ranks[alive], rows[alive], at[alive], best[alive]
                alive = np.ones(len(rows), bool)
            turns[rows] += alive
            if salts is not None:
                skipped = alive & self._skipped(salts[rows], step)
                ranks[skipped, at[skipped]] = _NEVER
                alive &= ~skipped
            move = np.flatnonzero(alive)
            if len(move):
                spot = at[move]
                source = np.minimum(column + (column > spot[:, None]), width)
                own, rank = np.take_along_axis(ids[move], source, axis=1), np.take_along_axis(ranks[move], source, axis=1)
                i = np.arange(len(move))
                own[i, spot] = self.by_rank[best[move]]
                before = np.flatnonzero(spot > 0)
                new = self._pair_ranks(np.append(own[i, spot], own[before, spot[before] - 1]), np.append(own[i, spot + 1], own[before, spot[before]]))
                rank[i, spot], rank[before, spot[before] - 1] = new[: len(move)], new[len(move) :]
                ids[move], ranks[move] = own, rank
            step += 1
        kept = final != -2
        flat, ends = final[kept], np.cumsum(kept.sum(axis=1))
        spelt = (final == -1).any(axis=1)
        raw = flat.tobytes()
        out, start = [], 0
        for word, end, odd in zip(words, ends.tolist(), spelt.tolist()):
            out.append(self._spelt(word, flat[start:end]) if odd else raw[4 * start : 4 * end])
            start = end
        return out, turns

    def _merge_long(self, word: str, salt: np.uint64 | None) -> tuple[bytes, int]:
        """As ``_merge``, for one word, in n log n.

        The heap holds rank and place of each candidate as one number, so ties
        go to the left. A pair that a merge has changed spells more than before
        and so has another rank: what the heap still holds of it is passed over.
        """
        if not self.rank_of:
            used = self.keys != _EMPTY
            self.rank_of = dict(zip(self.keys[used].tolist(), self.ranks[used].tolist()))
        rank_of, by_rank = self.rank_of, self.by_rank.tolist()
        symbols = self.symbol[np.frombuffer(word.encode("utf-32-le"), np.uint32)]
        n, never = len(symbols), int(_NEVER)
        first = self._pair_ranks(symbols[:-1], symbols[1:])
        places = np.flatnonzero(first != _NEVER)
        heap = (first[places].astype(np.int64) << 32 | places).tolist()
        heapq.heapify(heap)
        ids, ranks = symbols.tolist(), [*first.tolist(), never]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        turn, skips = 0, []
        while heap:
            top = heapq.heappop(heap)
            at, rank = top & 0xFFFFFFFF, top >> 32
            if ranks[at] != rank:
                continue
            if salt is not None:
                if turn % 65536 == 0:
                    skips = self._skipped(salt, np.arange(turn, turn + 65536)).tolist()
                if skips[turn % 65536]:
                    ranks[at] = never
                    turn += 1
                    continue
            turn += 1
            gone = after[at]
            right, left = after[gone], before[at]
            own = ids[at] = by_rank[rank]
            ids[gone], ranks[gone], after[at] = -2, never, right
            ranks[at] = never
            if right < n:
                before[right] = at
                if ids[right] >= 0 and (new := rank_of.get(own << 32 | ids[right])) is not None:
                    ranks[at] = new
                    heapq.heappush(heap, new << 32 | at)
            if left >= 0:
                ranks[left] = never
                if ids[left] >= 0 and (new := rank_of.get(ids[left] << 32 | own)) is not None:
                    ranks[left] = new
                    heapq.heappush(heap, new << 32 | left)
        kept = np.array(ids, np.int32)
        kept = kept[kept != -2]
        return self._spelt(word, kept) if (kept == -1).any() else kept.tobytes(), turn

    def _merge_all(self, words: list[str], salts: np.ndarray | None = None) -> tuple[list[bytes], np.ndarray]:
        """As ``_merge``, for words in order of length."""
        out, turns, at = [], [np.zeros(0, np.int64)], 0
        while at < len(words):
            if len(words[at]) > LONG:
                raw, count = self._merge_long(words[at], None if salts is None else salts[at])
                out.append(raw)
                turns.append(np.array([count]))
                at += 1
                continue
            # Words of similar length together, so rows times columns stay bounded.
            part = words[at : at + min(8192, (1 << 18) // len(words[at]))]
            while len(part[-1]) > min(LONG, 2 * len(part[0]) + 8):
                part = part[: len(part) // 2]
            raw, own = self._merge(part, None if salts is None else salts[at : at + len(part)])
            out += raw
            turns.append(own)
            at += len(part)
        return out, np.concatenate(turns)

    def _learn(self, words: set[str]) -> None:
        """Number new words and remember their pieces without skips."""
        new = sorted(words, key=len)
        raw, turns = self._merge_all(new)
        self.numbers.update(zip(new, range(len(self.plain), len(self.plain) + len(new))))
        self.plain += raw
        self.turns = np.append(self.turns, turns)
        # All neighbours at first, and two new ones a merge.
        self.bounds = np.append(self.bounds, np.array([3 * (len(w) - 1) for w in new], np.int64))

    def _vary(self, docs: list[list[str]], numbers: np.ndarray, salts: np.ndarray) -> tuple[list[int], list[bytes]]:
        """Places of all words one of whose candidates is skipped, and their pieces."""
        skips = np.zeros(len(numbers), np.uint64)

        def look(at: np.ndarray, until: np.ndarray) -> None:
            for turn in range(min(64, int(until.max(initial=0)))):
                at, until = at[until > turn], until[until > turn]
                skips[at] |= self._skipped(salts[at], turn).astype(np.uint64) << np.uint64(turn)

        turns, bounds = self.turns[numbers], self.bounds[numbers]
        look(np.flatnonzero(turns > 0), turns[turns > 0])
        places = np.flatnonzero((skips > 0) | (turns > 64))  # until its first skip a word goes the way without skips
        look(places, bounds[places])
        codes = np.where(bounds > 64, salts, skips)[places]  # skips that fill no more than a number, or what they follow from
        keys = list(zip(numbers[places].tolist(), codes.tolist()))
        new = {k: p for k, p in zip(keys, places.tolist()) if k not in self.varied}
        if new:
            words = [w for doc in docs for w in doc]
            todo = sorted(new.items(), key=lambda kp: len(words[kp[1]]))
            raw, _ = self._merge_all([words[p] for _, p in todo], salts[[p for _, p in todo]])
            self.varied.update(zip((k for k, _ in todo), raw))
        return places.tolist(), list(map(self.varied.__getitem__, keys))

    def _spelt(self, word: str, ids: np.ndarray) -> bytes:
        """Ids with the bytes of unknown characters in their places."""
        unknown = iter([c for c in word if self.symbol[ord(c)] < 0])
        spelt = [[i] if i >= 0 else [self.bytes[b] for b in next(unknown).encode()] for i in ids.tolist()]
        return np.array([i for s in spelt for i in s], np.int32).tobytes()

    def encode(self, texts: list[str | None], keys: list[int]) -> list[bytes]:
        """Piece ids of each text as 32-bit integers."""
        if len(self.plain) + len(self.varied) > REMEMBERED:
            self._forget()
        docs = [_SEGMENTS.findall(" " + text) if text else [] for text in texts]
        self._learn(set().union(*docs) - self.numbers.keys())
        numbers = [list(map(self.numbers.__getitem__, doc)) for doc in docs]
        out = [self.plain[i] for doc in numbers for i in doc]
        if self.dropout > 0 and out:
            of_key = _mix(np.array([key % 2**64 for key in keys], np.uint64))
            seed = np.uint64(self.seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            salts = np.concatenate([_mix(_mix(np.arange(len(doc), dtype=np.uint64) + k) + seed) for doc, k in zip(docs, of_key)])
            for place, raw in zip(*self._vary(docs, np.array([i for doc in numbers for i in doc], np.int64), salts)):
                out[place] = raw
        ends = np.cumsum([len(doc) for doc in docs]).tolist()
        return [b"".join(out[end - len(doc) : end]) for doc, end in zip(docs, ends)]

    def decode(self, ids: bytes) -> str:
        """The text of piece ids, all in the vocabulary; special pieces have none."""
        text = b"".join(map(self.decoded.__getitem__, np.frombuffer(ids, np.int32).tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches: enough texts for their words to be merged together, few enough to hold all their pieces."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def _encoded(shared, dropout: float, seed: int, emit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Pieces(**shared.value), dropout, seed)
        for batch in _batches(batches):
            names = batch.schema.names
            texts = batch.column(names.index("text")).to_pylist()
            keys = [0 if d is None else d for d in batch.column(names.index("doc_id")).to_pylist()]
            yield emit(batch, encoder, texts, encoder.encode(texts, keys))

    return run


def _lists(ids: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(i) // 4 for i in ids]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(ids), np.int32))


def encode_documents(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``docs`` with ``ids`` (array<int>), ``n_pieces``, and ``lossless``: whether the ids decode to the text.

    Columns of these names are replaced.

    ``dropout`` 0 gives the vocabulary's own segmentation. Otherwise a
    candidate is skipped with that chance, by a hash of the seed, the
    document, the word's place and the candidate's turn, so a rerun gives the
    same ids. Null and empty texts have no pieces. A missing doc_id counts as 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(load_pieces(model)))

    def emit(batch, encoder, texts, ids):
        same = [encoder.decode(i) == (t or "") for i, t in zip(ids, texts)]
        new = {"ids": _lists(ids), "n_pieces": pa.array([len(i) // 4 for i in ids], pa.int64()), "lossless": pa.array(same, pa.bool_())}
        return pa.RecordBatch.from_pydict({n: c for n, c in zip(batch.schema.names, batch.columns) if n not in new} | new)

    return docs.mapInArrow(_encoded(shared, dropout, seed, emit), with_fields(docs, "ids array<int>, n_pieces bigint, lossless boolean"))


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``: the text of ``ids`` (empty for null), as a column that replaces one of its name.

    Null ids and those outside the vocabulary have no text, as special pieces.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(vars(load_pieces(model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Pieces(**shared.value), 0)
        for batch in _batches(batches):
            size = len(encoder.decoded)
            known = ([i for i in row.as_py() or [] if i is not None and 0 <= i < size] for row in batch.column(batch.schema.names.index("ids")))
            texts = [encoder.decode(np.array(ids, np.int32).tobytes()) for ids in known]
            kept = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "decoded"}
            yield pa.RecordBatch.from_pydict(kept | {"decoded": pa.array(texts, pa.string())})

    return encoded.mapInArrow(run, with_fields(encoded, "decoded string"))


def round_trip(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``doc_id, n_pieces, ids_sha256, decoded_sha256, lossless`` of every document, encoded and decoded in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(load_pieces(model)))

    def emit(batch, encoder, texts, ids):
        back = [encoder.decode(i) for i in ids]
        return pa.record_batch({
            "doc_id": batch.column(batch.schema.names.index("doc_id")), "n_pieces": pa.array([len(i) // 4 for i in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
            "decoded_sha256": pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back]),
            "lossless": pa.array([b == (t or "") for b, t in zip(back, texts)]),
        })

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return docs.mapInArrow(_encoded(shared, dropout, seed, emit), "doc_id bigint, n_pieces bigint, ids_sha256 string, decoded_sha256 string, lossless boolean")
