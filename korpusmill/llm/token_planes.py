"""Token ids in binary files of bit planes.

Texts are encoded with a public tokenizer and their ids written, in ascending
order of doc_id, to files that other programs can map and seek in. A file is

    header    magic, version, planes per byte (8 or 1), bytes an id, ids a block
    planes    each block of ids, transposed to its bit (or byte) planes, each
              plane a zstandard frame; a plane of zeros has no bytes
    documents doc_id, whether it has one, and its number of ids, zstandard
    chunks    for each block its ids and the size of each plane, uint32
    footer    places and numbers of all these, the file's range and turn

so any block can be read alone. Spark's own writer puts each file in place, so
a lost task leaves nothing behind and files go wherever Spark can write.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korpusmill.llm.common import doc_order
from korpusmill.session import shared_folder, store

END_ID = 1
#: Ids of a block, ids from which on a file ends with its document, code points a range of documents has on average.
BLOCK_IDS, FILE_IDS, RANGE_CHARS, MAX_RANGES = 1 << 16, 1 << 21, 8 << 20, 4096
#: Chunks between blanks whose ids a task remembers; when there are more it forgets all. Longer chunks are not kept.
REMEMBERED, LONGEST_KEPT = 500_000, 64
#: Bytes of text, about, that a task encodes at once.
SLICE_BYTES = 4 << 20
LEVEL = 3
_MAGIC, _VERSION = b"KMBP", 1
_HEADER, _FOOTER = "<4sBBBxI", "<QQQQQQII4s"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- encoding
#: Fixed values of the default tokenizer: steps before its merges, under which chunks can be encoded apart.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Letters of Latin-1 in lower case, in UTF-8: no composition of theirs reaches beyond them.
_LOW = rb"[a-z]|\xc3[\x9f-\xb6\xb8-\xbf]"
#: Plain chunks: such letters and printable ASCII without capitals, apostrophes (contractions) and "<" (added tokens); their pieces, as the pattern cuts them.
_PLAIN, _PIECES = re.compile(rb"(?:[!-&(-;=-@\[-~]|\xc3[\x9f-\xb6\xb8-\xbf])+"), re.compile(rb"(?:" + _LOW + rb")+|[0-9]|[^a-z0-9\x80-\xff]+")
#: Characters that stand for bytes in the model's words, as the library's step "ByteLevel" writes them.
_OWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = "".join(" " if b == 32 else chr(b if b in _OWN else 256 + b - sum(o < b for o in _OWN)) for b in range(256))


def encodes_chunks(tokenizer: str) -> bool:
    """Whether no token crosses a blank or line feed, blanks leave none, and A-Z count as a-z."""
    spec = json.loads(tokenizer)
    normal = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    first = next(iter((spec.get("pre_tokenizer") or {}).get("pretokenizers", [])), {})
    added = [t for t in spec.get("added_tokens") or [] if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or not t["content"].startswith("<|")]
    cut = (first.get("type"), first.get("pattern"), first.get("behavior"), first.get("invert"))
    return normal == _NORMAL and cut == ("Split", {"Regex": _PATTERN}, "Removed", True) and not added


def last_tokens(tokenizer: str) -> np.ndarray | None:
    """By id, whether a token ends a piece of the pattern; none if the model does not mark such."""
    model = json.loads(tokenizer)["model"]
    mark = model.get("end_of_word_suffix")
    if not mark:
        return None
    marked = [i for t, i in model["vocab"].items() if t.endswith(mark)]
    return np.isin(np.arange(1 << 16 if max(model["vocab"].values()) < 1 << 16 else max(model["vocab"].values()) + 1), marked)


class Encoder(dict):
    """Ids of whole texts as packed little-endian numbers, by the tokenizers library.

    With the default tokenizer, chunks between blanks are encoded each for
    itself and remembered here, by their place in ``ids``; one mark after a
    letter and before a blank is a chunk of its own. Arrow numbers the chunks of
    all texts of a call, so each is looked up once a call, and numpy puts the
    ids together. New plain chunks are cut to pieces as the pattern does, and
    new pieces are encoded in one call of the model alone, less than half as
    dear: the library marks the last token of each. Other tokenizers encode each
    text at once. A broadcast encoder lives, with its memory, as long as a
    Python worker.
    """

    def __init__(self, tokenizer: str, width: int):
        self.model, self.kind, self.tokenizer = tokenizer, {2: "H", 4: "I"}[width], None

    def __reduce__(self):
        return Encoder, (self.model, {"H": 2, "I": 4}[self.kind])

    def _open(self) -> None:
        # Spark has a worker a core; the library's own threads would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.chunked = Tokenizer.from_str(self.model), encodes_chunks(self.model)
        self.last = last_tokens(self.model) if self.chunked else None
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.ids, self.places = np.zeros(1 << 16, self.kind), np.zeros(1 << 14, np.int64)  # of chunk k: ids[places[k] : places[k + 1]]
        self.n = 0

    def _encode(self, text: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> range:
        """Numbers of new chunks with so many of these ids each."""
        first, at = self.n, int(self.places[self.n])
        self.n += len(sizes)
        while len(self.places) <= self.n:
            self.places = np.concatenate([self.places, np.zeros_like(self.places)])
        self.places[first + 1 : self.n + 1] = at + np.cumsum(sizes)
        while len(self.ids) < at + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[at : at + len(ids)] = ids
        return range(first, self.n)

    def _of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these chunks, one chunk after the other, and how many each has."""
        first = self.places[numbers]
        sizes = self.places[numbers + 1] - first
        until = np.cumsum(sizes)
        return self.ids[np.repeat(first - until + sizes, sizes) + np.arange(sizes.sum())], sizes

    def _join(self, some: list) -> tuple[np.ndarray, np.ndarray]:
        return np.fromiter(chain.from_iterable(some), self.kind), np.fromiter(map(len, some), np.int64, len(some))

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.last is not None and pieces:
            text = codecs.charmap_decode(b" ".join(pieces), "strict", _BYTE_CHARS)[0]
            ids = np.array(self.pieces.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(pieces):
                return ids, np.diff(ends, prepend=0)
        return self._join([np.frombuffer(self._encode(p.decode()), self.kind) for p in pieces])

    def _learn(self, chunks: list[bytes], end_id: int) -> list[int]:
        """Numbers of chunks that are not known; long ones and the end of a text come last and are not remembered."""
        cut = {c: _PIECES.findall(c) for c in chunks if _PLAIN.fullmatch(c)}
        pieces = [p for p in dict.fromkeys(chain.from_iterable(cut.values())) if p not in self]
        short = [p for p in pieces if len(p) <= LONGEST_KEPT]
        self.update(zip(short, self._add(*self._encode_pieces(short))))
        # Plain chunks of several pieces, and long ones after them.
        known, passing = self.n, {}
        if len(short) < len(pieces):
            long = [p for p in pieces if len(p) > LONGEST_KEPT]
            passing = dict(zip(long, self._add(*self._encode_pieces(long))))
        made = [c for c, parts in cut.items() if len(parts) > 1 and len(c) <= LONGEST_KEPT]
        made, kept = made + [c for c in cut if len(c) > LONGEST_KEPT], len(made)
        parts = [passing[p] if p in passing else self[p] for c in made for p in cut[c]]
        ids, sizes = self._of(np.array(parts, np.int64))
        sizes = np.diff(np.cumsum(sizes)[np.cumsum([len(cut[c]) for c in made], dtype=np.int64) - 1], prepend=0)
        self.n, at = known, int(sizes[:kept].sum())
        self.update(zip(made[:kept], self._add(ids[:at], sizes[:kept])))
        others = [c for c in chunks if c not in cut and c != b"\xff"]
        others.sort(key=lambda c: len(c) > LONGEST_KEPT)
        coded = [e.ids for e in self.tokenizer.encode_batch_fast([c.decode() for c in others], add_special_tokens=False)] if others else []
        few = sum(len(c) <= LONGEST_KEPT for c in others)
        self.update(zip(others[:few], self._add(*self._join(coded[:few]))))
        self.kept = self.n
        passing = dict(zip(made[kept:], self._add(ids[at:], sizes[kept:])))
        passing |= zip([*others[few:], b"\xff"], self._add(*self._join([*coded[few:], [end_id]])))
        return [passing[c] if c in passing else self[c] for c in chunks]

    def __call__(self, texts: list[str | None], end_id: int) -> list[bytes]:
        if not self.tokenizer:
            self._open()
        if not self.chunked:
            end = array(self.kind, [end_id]).tobytes()
            return [self._encode(t or "") + end for t in texts]
        if not texts:
            return []
        if len(self) > REMEMBERED:
            self._forget()
        raw = [(t or "").encode() for t in texts]
        blob = b" \xff ".join([t if b"<|" in t else t.lower() for t in raw] + [b""])  # A-Z alone; a byte that no text holds
        x = np.frombuffer(bytearray(blob.replace(b"\n", b" ")), np.uint8)
        # Some small letters compose with other marks than their capitals: such capitals stay before other scripts and marks.
        stay = np.flatnonzero(x >= 0xC4) - 1
        stay = stay[_UNPAIRED[x[stay]]]
        if stay.size:
            x[stay] = np.frombuffer(b" \xff ".join([*raw, b""]), np.uint8)[stay]
        two = np.flatnonzero(x == 0xC3) + 1  # capitals of Latin-1
        x[two[_CAPITAL[x[two]]]] += 32
        marks = np.flatnonzero(_MARK[x[1:-1]] & (x[2:] == 32)) + 1
        before = x[marks - 1]
        marks = marks[_LETTER[before] | _LOW_SECOND[before] & (x[marks - 2] == 0xC3)]
        x = np.insert(x, marks, 32)
        ends = np.concatenate([[0], np.flatnonzero(x == 32) + 1])
        coded = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(x)]).dictionary_encode()
        chunks = b"".join(coded.dictionary.buffers()[2:]).split(b" ", len(coded.dictionary))[:-1]
        numbers = np.fromiter(map(self.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(numbers < 0)
        numbers[new] = self._learn([chunks[k] for k in new.tolist()], end_id)
        of = numbers[coded.indices.to_numpy()]
        ids, sizes = self._of(of)
        self.n = self.kept
        stops = np.cumsum(sizes)[of == numbers[chunks.index(b"\xff")]].tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *stops], stops)]


def _bytes_of(some) -> np.ndarray:
    return np.isin(np.arange(256), list(some))


_MARK, _LETTER = _bytes_of(b".,;:!?"), _bytes_of([*range(97, 123), *range(65, 91)])
#: What follows 0xC3 in capitals and in small letters of Latin-1.
_CAPITAL, _LOW_SECOND = _bytes_of({*range(0x80, 0x9F)} - {0x97}), _bytes_of({*range(0x9F, 0xC0)} - {0xB7})
#: Small letters of ASCII that compose with other marks than their capitals do.
_UNPAIRED = _bytes_of(b"hijtwy")


def id_width(tokenizer: str, end_id: int = END_ID) -> int:
    """Bytes that the tokenizer's largest id needs: 2 or 4."""
    from tokenizers import Tokenizer

    largest = max([end_id, *Tokenizer.from_str(tokenizer).get_vocab(with_added_tokens=True).values()])
    return 2 if largest < 1 << 16 else 4


# --- the file format
def to_planes(ids: np.ndarray, bits: bool) -> np.ndarray:
    """Rows are planes: of all ids the lowest bit (byte) first, eight ids a byte for bits."""
    raw = np.ascontiguousarray(ids).view(np.uint8).reshape(len(ids), -1)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little") if bits else np.ascontiguousarray(raw.T)


def from_planes(planes: np.ndarray, n: int, width: int, bits: bool) -> np.ndarray:
    raw = np.packbits(np.unpackbits(planes, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little") if bits else planes[:, :n].T
    return np.ascontiguousarray(raw).view(f"<u{width}").ravel()


class FileWriter:
    """Collects documents and gives the bytes of one file."""

    def __init__(self, width: int, bits: bool, block_ids: int = BLOCK_IDS, level: int = LEVEL):
        self.width, self.bits, self.block_ids, self.zip = width, bits, block_ids, zstandard.ZstdCompressor(level=level)
        self.parts, self.sizes, self.waiting, self.docs, self.counts = [struct.pack(_HEADER, _MAGIC, _VERSION, 8 if bits else 1, width, block_ids)], [], b"", [], []

    def add(self, doc: int | None, ids: bytes) -> None:
        self.docs.append(doc)
        self.counts.append(len(ids) // self.width)
        data = self.waiting + ids if self.waiting else ids
        whole, step = 0, self.block_ids * self.width
        while len(data) - whole >= step:
            self._block(data[whole : whole + step])
            whole += step
        self.waiting = data[whole:]

    def _block(self, data: bytes) -> None:
        ids = np.frombuffer(data, f"<u{self.width}")
        frames = [self.zip.compress(p.tobytes()) if p.any() else b"" for p in to_planes(ids, self.bits)]
        self.parts += frames
        self.sizes.append([len(ids), *map(len, frames)])

    def close(self, bucket: int, turn: int) -> bytes:
        if self.waiting:
            self._block(self.waiting)
        at = sum(map(len, self.parts))
        docs = np.array([d or 0 for d in self.docs], "<i8").tobytes() + np.array([d is not None for d in self.docs], np.uint8).tobytes()
        index = self.zip.compress(docs + np.array(self.counts, "<u8").tobytes())
        chunks = np.array(self.sizes, "<u4").tobytes()
        footer = struct.pack(_FOOTER, at, len(index), len(chunks), len(self.docs), len(self.sizes), sum(self.counts), bucket, turn, _MAGIC)
        return b"".join([*self.parts, index, chunks, footer])


@dataclass
class TokenFile:
    """A file's content opened for reading; blocks are unpacked when asked for."""

    content: bytes

    def __post_init__(self):
        end = len(self.content) - (self.content[-1:] == b"\n")  # the line end that Spark's text writer adds
        at, index, chunks, self.n_docs, blocks, self.n_ids, self.bucket, self.turn, magic = struct.unpack_from(_FOOTER, self.content, end - struct.calcsize(_FOOTER))
        start, version, planes, self.width, self.block_ids = struct.unpack_from(_HEADER, self.content)
        if (start, magic, version) != (_MAGIC, _MAGIC, _VERSION):
            raise ValueError("not a file of token planes")
        self.bits, self.unzip = planes == 8, zstandard.ZstdDecompressor()
        self.sizes = np.frombuffer(self.content, "<u4", chunks // 4, at + index).reshape(blocks, -1).astype(np.int64)
        self.places = struct.calcsize(_HEADER) + np.concatenate(([0], np.cumsum(self.sizes[:, 1:].sum(axis=1))))
        docs = self.unzip.decompress(self.content[at : at + index])
        self.doc_ids = np.frombuffer(docs, "<i8", self.n_docs)
        self.has_id = np.frombuffer(docs, np.uint8, self.n_docs, 8 * self.n_docs).astype(bool)
        self.counts = np.frombuffer(docs, "<u8", self.n_docs, 9 * self.n_docs).astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        n, sizes, at = int(self.sizes[k, 0]), self.sizes[k, 1:], int(self.places[k])
        row = -(-n // 8) if self.bits else n
        planes = np.zeros((len(sizes), row), np.uint8)
        for p, size in enumerate(sizes):
            if size:
                planes[p] = np.frombuffer(self.unzip.decompress(self.content[at : at + int(size)]), np.uint8)
                at += int(size)
        return from_planes(planes, n, self.width, self.bits)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids by place in the file; only the blocks that hold them are unpacked."""
        if start >= stop:
            return np.zeros(0, f"<u{self.width}")
        first = start // self.block_ids
        got = np.concatenate([self.block(k) for k in range(first, -(-stop // self.block_ids))])
        return got[start - first * self.block_ids : stop - first * self.block_ids]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, place in the file, ids; a block is unpacked once."""
        held, at, begins = np.zeros(0, f"<u{self.width}"), 0, 0
        following = 0
        for doc, known, n in zip(self.doc_ids.tolist(), self.has_id, self.counts.tolist()):
            more = [held[at - begins :]]
            have = len(more[0])
            while have < n:
                more.append(self.block(following))
                have += len(more[-1])
                following += 1
            held, begins = np.concatenate(more) if len(more) > 1 else more[0], at
            yield doc if known else None, at, held[:n]
            at += n


# --- Spark
def _encode(encoder, end_id: int, bounds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder.value
        for batch in batches:
            keys, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            # Rows of one key that spans several ranges are dealt to them by their text's hash.
            low, high = np.searchsorted(bounds, keys, "left"), np.searchsorted(bounds, keys, "right")
            share = (ties.astype(np.float64) + 2.0**63) / 2.0**64
            bucket = np.minimum(low + (share * (high - low + 1)).astype(np.int64), high)
            bucket = np.where(high > low, bucket, high)
            slices = np.cumsum(pc.fill_null(pc.binary_length(batch.column(3)), 0).to_numpy(), dtype=np.int64) // SLICE_BYTES
            at = [0, *(np.flatnonzero(np.diff(slices)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(at, at[1:]):
                part = batch.slice(start, stop - start)
                ids = encode(part.column(3).to_pylist(), end_id)
                yield pa.record_batch({
                    "bucket": pa.array(bucket[start:stop].astype(np.int32)), "key": part.column(0), "tie": part.column(1),
                    "doc_id": part.column(2), "ids": pa.array(ids, pa.binary()),
                })

    return run


def _to_files(width: int, bits: bool, block_ids: int, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, bucket, turn, held = None, None, 0, 0

        def closed():
            return pa.record_batch({"file": [f"{bucket:05d}-{turn:06d}"], "content": pa.array([writer.close(bucket, turn)], pa.binary())})

        for batch in batches:
            for b, doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if writer and (b != bucket or held >= file_ids):
                    yield closed()
                    writer, turn = None, turn + 1
                if b != bucket:
                    bucket, turn = b, 0
                if not writer:
                    writer, held = FileWriter(width, bits, block_ids), 0
                ids = ids.as_py()
                writer.add(doc, ids)
                held += len(ids) // width
        if writer:
            yield closed()

    return run


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, bits: bool = True,
    block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS, range_chars: int = RANGE_CHARS,
) -> None:
    """Encode every whole text, append ``end_id`` to each, and write the ids below ``path`` in ascending doc_id order.

    Null and empty texts have the end id alone. Rows without doc_id come last.
    Rows of one doc_id follow each other by a hash of their text, then by ids.
    Repeated rows are all written. Other columns are ignored. An empty table
    makes no file. ``tokenizer`` is the path of a file of the tokenizers
    library, read by the driver, whose tokens must not hold blanks.

    Documents are dealt to ranges of doc_id by quantiles of that column, about
    ``range_chars`` code points each; a doc_id that fills several ranges is
    split. A range is written as one file or more, each ended by the first
    document with which it holds ``file_ids`` ids.
    """
    spark = docs.sparkSession
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        model = f.read()
    width = id_width(model, end_id)
    keyed = docs.select(
        doc_order().alias("key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )
    grid = [i / MAX_RANGES for i in range(1, MAX_RANGES)]
    chars, quantiles = keyed.agg(F.sum(F.length("text")), F.percentile_approx("key", grid, 20 * MAX_RANGES)).first()
    ranges = min(MAX_RANGES, max(1, -(-(chars or 0) // range_chars)))
    bounds = np.array([quantiles[i * MAX_RANGES // ranges - 1] for i in range(1, ranges)] if quantiles else [], np.int64)
    coded = keyed.mapInArrow(
        _encode(spark.sparkContext.broadcast(Encoder(model, width)), end_id, bounds), "bucket int, key bigint, tie bigint, doc_id bigint, ids binary"
    )
    ordered = coded.repartition(ranges, "bucket").sortWithinPartitions("bucket", "key", "tie", "ids").select("bucket", "doc_id", "ids")
    files = ordered.mapInArrow(_to_files(width, bits, block_ids, file_ids), "file string, content binary")
    # A cast keeps bytes as they are, and the text writer writes them so, a line end after each file.
    files.select("file", F.col("content").cast("string").alias("value")).write.partitionBy("file").text(path)


def _read(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                opened = TokenFile(content.as_py())
                rows, size = [], 0
                for doc, at, ids in opened.documents():
                    wide = ids.astype("<u4")
                    rows.append((doc, at, len(ids), zlib.crc32(wide.tobytes()), wide if with_ids else None))
                    size += len(ids)
                    if size >= FILE_IDS // 8:
                        yield _batch(rows, opened, with_ids)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, opened, with_ids)

    return run


def _batch(rows: list[tuple], opened: TokenFile, with_ids: bool) -> pa.RecordBatch:
    doc, at, n, crc, ids = zip(*rows)
    columns = {
        "bucket": pa.array([opened.bucket] * len(rows), pa.int64()), "turn": pa.array([opened.turn] * len(rows), pa.int64()),
        "doc_id": pa.array(doc, pa.int64()), "at": pa.array(at, pa.int64()), "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
    }
    if with_ids:
        columns["ids"] = pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64()))
    return pa.record_batch(columns)


_READ = "bucket bigint, turn bigint, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document in the files below ``path``.

    ``start`` counts the ids of all documents before it, over all files in
    order. ``ids_crc32`` is the unsigned CRC-32 of the ids as little-endian
    32-bit numbers. A folder without files gives no row.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("content")
    rows = files.mapInArrow(_read(with_ids), _READ + ", ids array<bigint>" * with_ids)
    if not with_ids:  # unpacked once; these rows are narrow
        rows = store(rows, shared_folder(spark, "token-documents"))
    totals = rows.groupBy("bucket", "turn").agg(F.sum("n_tokens").alias("n"))
    totals = store(totals, shared_folder(spark, "token-totals"))  # a row a file
    before, sums = 0, []
    for bucket, n in sorted(totals.groupBy("bucket").agg(F.sum("n")).collect()):  # MAX_RANGES rows at most
        sums.append((bucket, before))
        before += n
    inside = "coalesce(sum(n) over (partition by bucket order by turn rows between unbounded preceding and 1 preceding), 0)"
    starts = totals.join(F.broadcast(spark.createDataFrame(sums, "bucket bigint, before bigint")), "bucket")
    starts = starts.select("bucket", "turn", (F.col("before") + F.expr(inside)).alias("file_start"))
    start = (F.col("file_start") + F.col("at")).alias("start")
    return rows.join(starts, ["bucket", "turn"]).select("doc_id", start, "n_tokens", "ids_crc32", *["ids"] * with_ids)
