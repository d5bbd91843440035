import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from korpusmill.llm import token_planes
from korpusmill.llm.token_planes import Encoder, FileWriter, TokenFile, default_tokenizer, from_planes, id_width, read_token_files, to_planes, write_token_files

rng = random.Random(5)
MODEL = open(default_tokenizer(), encoding="utf-8").read()
LIBRARY = Tokenizer.from_str(MODEL)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def prose(n):
    return " ".join("".join(rng.choice("abcdefg hi\n.,'É") for _ in range(rng.randint(1, 12))) for _ in range(n))


ODD = [
    "", None, " ", "\n\n", "Word, WORD. wOrd", "x.", "..", "a..", "a.b", "<|ENDOFTEXT|>", "<|endoftext|>.", "  <|endoftext|> x", "a\x0bb\x0c c\r\nd",
    "ΣΑΣ ΣΑΣ", "é ́a é.", "it's", "İ x", "a\xa0b", "a" * 3000, "한글 가", "😀 😀.", "a's b'", "\x85a\x1cb", "12. 3,4", "x" * 65 + ".", "Éa. éa", "<|startoftext|>. Word. A", "A.", ".", "a. ", "É. e\u0301. a\u0301.",
]


def test_chunks_give_the_ids_of_whole_texts():
    encode = Encoder(MODEL, 2)
    texts = ODD + [prose(50) for _ in range(100)]
    for _ in "ab":  # with and without memory
        assert [np.frombuffer(x, "<u2").tolist() for x in encode(texts, 1)] == [ids_of(t) for t in texts]
    assert encode.chunked and b"word" in encode and b"word," not in encode and b"x" * 65 not in encode


def test_memory_ends(monkeypatch):
    monkeypatch.setattr(token_planes, "REMEMBERED", 10)
    encode = Encoder(MODEL, 2)
    for t in [prose(40) for _ in range(5)] * 2:
        assert np.frombuffer(encode([t], 1)[0], "<u2").tolist() == ids_of(t)


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers

    model = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    encode, library = Encoder(model, 2), Tokenizer.from_str(model)
    assert id_width(model) == 2 and id_width(model, 70_000) == 4
    texts = ["A b  c\n d", "Word. word", ""]
    assert [np.frombuffer(x, "<u2").tolist() for x in encode(texts, 7)] == [library.encode(t, add_special_tokens=False).ids + [7] for t in texts]
    assert not encode.chunked


@pytest.mark.parametrize("bits", [True, False])
@pytest.mark.parametrize("width", [2, 4])
def test_planes(bits, width):
    ids = np.array([rng.randrange(1 << 8 * width) for _ in range(77)], f"<u{width}")
    planes = to_planes(ids, bits)
    assert len(planes) == (8 if bits else 1) * width
    if bits:
        assert [int(b) for b in np.unpackbits(planes[3], count=77, bitorder="little")] == [int(i) >> 3 & 1 for i in ids]
    else:
        assert planes[1].tolist() == [int(i) >> 8 & 255 for i in ids]
    assert from_planes(planes, 77, width, bits).tolist() == ids.tolist()


@pytest.mark.parametrize("bits", [True, False])
def test_file_round_trip_and_seeking(bits):
    docs = [(i if i % 5 else None, np.array([rng.randrange(3 if i % 2 else 49_000) for _ in range(rng.randint(0, 40))], "<u2")) for i in range(60)]
    writer = FileWriter(2, bits, block_ids=64)
    for doc, ids in docs:
        writer.add(doc, ids.tobytes())
    opened = TokenFile(writer.close(3, 9) + b"\n")
    assert (opened.bucket, opened.turn, opened.n_docs, opened.bits) == (3, 9, 60, bits)
    every = np.concatenate([i for _, i in docs])
    assert [(d, at, i.tolist()) for d, at, i in opened.documents()] == [(d, sum(len(x) for _, x in docs[:k]), i.tolist()) for k, (d, i) in enumerate(docs)]
    for start, stop in ((0, 0), (0, 1), (63, 65), (64, 128), (100, len(every)), (5, 5)):
        assert opened.ids(start, stop).tolist() == every[start:stop].tolist()
    assert opened.sizes[:, 0].tolist() == [64] * (len(every) // 64) + [len(every) % 64] * (len(every) % 64 > 0)
    with pytest.raises(ValueError):
        TokenFile(b"x" * 200)


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out, start = [], 0
    for doc, text in order:
        ids = ids_of(text)
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, docs, tmp_path, **options):
    path = f"{tmp_path}/files"
    write_token_files(docs, path, **options)
    return read_token_files(spark, path, with_ids=True).orderBy("start").collect()


@pytest.mark.parametrize("options", [{}, {"range_chars": 2000, "file_ids": 100, "block_ids": 32}, {"range_chars": 300, "bits": False, "file_ids": 1}])
def test_written_files_hold_all_documents_in_order(spark, documents, tmp_path, options):
    rows = [(i * 7 % 211 - 20, prose(rng.randint(0, 30))) for i in range(211)] + [(1000 + i, t) for i, t in enumerate(ODD)]
    got = written(spark, documents(rows), tmp_path, **options)
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == expected(rows)
    texts = dict(rows)
    assert all(r["ids"] == ids_of(texts[r["doc_id"]]) for r in got)


def test_ties_and_missing_ids(spark, documents, tmp_path):
    rows = [(5, prose(9)) for _ in range(60)] + [(5, "same words")] * 4 + [(None, "z"), (None, None), (1, "a"), (9, "")]
    got = written(spark, documents(rows), tmp_path, range_chars=500, file_ids=30)
    assert [r["doc_id"] for r in got] == [1] + [5] * 64 + [9, None, None]
    assert sorted(r["ids"] for r in got) == sorted(ids_of(t) for _, t in rows)
    starts = [r["start"] for r in got]
    assert starts == [sum(r["n_tokens"] for r in got[:k]) for k in range(len(got))]


def test_one_id_fills_several_ranges(spark, documents, tmp_path):
    write_token_files(documents([(5, prose(20)) for _ in range(400)]), f"{tmp_path}/f", range_chars=4000)
    assert len({p.name.split("-")[0] for p in (tmp_path / "f").iterdir() if p.name.startswith("file=")}) > 2


def test_no_documents(spark, documents, tmp_path):
    assert written(spark, documents([]), tmp_path) == []


def test_new_words_of_a_batch_are_encoded_in_one_call():
    texts = ["ab12cd", "x_1,y--z", "A1B2 c3.", "don't1 it's2", "<|endoftext|>9z", "a<b3", "$5.00/ab~c", "é1 a½b", "q7" * 40, "1" * 70, "[x](y)!?", "ÉÀß × ÷ ñandú a×b İi", "aö aª º"]
    for batch in (texts, texts + [prose(300) for _ in range(3)], ["\x00 ab</w>c </w> a\xffb"]):
        assert [np.frombuffer(g, "<u2").tolist() for g in Encoder(MODEL, 2)(batch, 1)] == [ids_of(t) for t in batch]
    encoder, asked = Encoder(MODEL, 2), []
    encoder([""], 1)
    encode = encoder._encode
    encoder._encode = lambda text: asked.append(text) or encode(text)
    words = ["".join(rng.choice("bcdfgkéü") for _ in range(9)) for _ in range(500)]
    got = encoder([" ".join(words[:300]), " ".join(f"{w}k." for w in words[300:])], 1)
    assert len(asked) <= 3
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [ids_of(" ".join(words[:300])), ids_of(" ".join(f"{w}k." for w in words[300:]))]


def test_small_letters_that_compose_with_more_than_capitals():
    marks = [chr(c) for c in (0x300, 0x301, 0x307, 0x308, 0x30A, 0x30C, 0x316, 0x323, 0x331, 0x344)]
    texts = [f"a{c}{m}b {c}{m}. {c}\u0316{m} {c}é{m} x" for c in [*map(chr, range(65, 91)), *map(chr, range(0xC0, 0xE0))] for m in marks]
    assert [np.frombuffer(g, "<u2").tolist() for g in Encoder(MODEL, 2)(texts, 1)] == [ids_of(t) for t in texts]


def test_words_with_accents_and_marks_are_not_asked_for_one_by_one():
    encoder, asked = Encoder(MODEL, 2), []
    encoder([""], 1)
    encode = encoder._encode
    encoder._encode = lambda text: asked.append(text) or encode(text)
    words = ["".join(rng.choice("ÉÀbkéüßø") for _ in range(7)) for _ in range(300)] + ["é" * 40, "x" * 70 + "-1"]
    texts = [" ".join(f"{w}{rng.choice(['.', ',!!', '-7', ''])}" for w in words)] * 2
    got = encoder(texts, 1)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [ids_of(t) for t in texts]
    assert len(asked) <= 3
    assert max(map(len, encoder)) <= token_planes.LONGEST_KEPT and encoder.n == len(set(encoder.values()))


def test_slices_of_a_batch(monkeypatch):
    monkeypatch.setattr(token_planes, "SLICE_BYTES", 50)
    bounds = np.array([], np.int64)
    texts = [None, "", prose(3), prose(60), None, prose(40)] * 3
    batch = pa.record_batch({"key": [*range(18)], "tie": [0] * 18, "doc_id": [*range(18)], "text": pa.array(texts, pa.string())})
    empty = batch.slice(0, 0)
    broadcast = type("Broadcast", (), {"value": Encoder(MODEL, 2)})
    out = list(token_planes._encode(broadcast, 1, bounds)(iter([batch, empty])))
    assert len(out) > 4
    got = [(d, np.frombuffer(i, "<u2").tolist()) for b in out for d, i in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist())]
    assert got == [(k, ids_of(t)) for k, t in enumerate(texts)]
