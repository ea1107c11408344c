"""Operator 1 against the sentencepiece library, for BPE and unigram files."""

import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from quarry.llm import piece_codec

ODD = [" a  b", "", "a ", "  ", "x\n\ny  z", "日本 語 a\n b", "tab\tb", "▁a ▁", "\n", "<s> </s> <0x0A>", "e.g., it's \U0001f600.", "a \nb", "\nThe end."]


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(number, data):
    return varint(number << 3 | 2) + varint(len(data)) + data


def number(n, value):
    return varint(n << 3) + varint(value)


@pytest.fixture(scope="module")
def unigram_path(tmp_path_factory):
    """A hand-written unigram model with byte fallback (nothing is trained)."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words = ["▁", "a", "b", "c", "e", "h", "i", "n", "r", "s", "t", "▁t", "▁th", "he", "▁the", "in", "▁in", "the", "an", "▁a", "cat", "▁cat", "rain", "er", "est"]
    pieces += [(w, -1.0 - 0.37 * i, 1) for i, w in enumerate(words)]
    data = b"".join(message(1, message(1, p.encode()) + varint(2 << 3 | 5) + struct.pack("<f", s) + number(3, k)) for p, s, k in pieces)
    data += message(2, number(3, 1) + number(4, len(pieces)) + number(35, 1) + number(40, 0) + number(41, 1) + number(42, 2))
    data += message(3, message(1, b"identity") + number(3, 1) + number(4, 1) + number(5, 1))
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(data)
    return str(path)


def check(path, texts):
    codec = piece_codec.Codec(path)
    reference = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, lens, ok = codec.encode(pa.array(texts))
    ends = np.cumsum(lens)
    got = [ids[e - n : e].tolist() for e, n in zip(ends, lens, strict=True)]
    assert got == reference.encode([t or "" for t in texts])
    assert codec.decode(ids, lens) == [reference.decode(g) for g in got]
    return codec, ok


def test_bpe_model_equals_the_reference(piece_path, texts):
    codec, ok = check(piece_path, list(texts.values()))
    assert codec.by_unit and ok.all()


def test_bpe_model_on_odd_texts(piece_path):
    codec = piece_codec.Codec(piece_path)
    ids, lens, ok = codec.encode(pa.array([*ODD, None]))
    ends = np.cumsum(lens)
    want = codec.reference.encode([*ODD, ""])
    assert [ids[e - n : e].tolist() for e, n in zip(ends, lens, strict=True)] == want
    assert ok.all()


def test_small_caches_change_nothing(piece_path, texts):
    codec = piece_codec.Codec(piece_path, cache_units=100)
    sample = pa.array(list(texts.values())[:50])
    for _ in range(2):
        ids, lens, _ = codec.encode(sample)
    assert (ids == piece_codec.Codec(piece_path).encode(sample)[0]).all()


def test_unigram_model_equals_the_reference(unigram_path):
    texts = ["the cat in the rain", "  the   cat ", "an ant, a hat!", "zebra ééé", "", "the\ncat"]
    codec, ok = check(unigram_path, texts)
    assert not codec.by_unit and codec.model.kind == piece_codec.UNIGRAM and ok.all()


def test_a_wrong_merge_order_is_seen(piece_path):
    codec = piece_codec.Codec(piece_path)
    codec._plain = lambda escaped: b"\0\0\0\0"
    ids, lens, ok = codec.encode(pa.array(["some words", "more"]))
    assert not ok.any() and ids.tolist() == sum(codec.reference.encode(["some words", "more"]), [])


def test_encode_and_decode_tables(spark, docs, texts, piece_path):
    encoded = piece_codec.encode(docs, piece_path)
    back = {r.doc_id: r.text for r in piece_codec.decode(encoded, piece_path).collect()}
    assert back == {d: t or "" for d, t in texts.items()}
    assert all(r.round_trip and r.parity for r in piece_codec.round_trip(docs, piece_path).collect())


def test_two_threads_give_the_same_ids(piece_path, texts):
    sample = [t or "" for t in list(texts.values())[:40]]
    codec = piece_codec.Codec(piece_path)
    assert [e.ids for e in codec.tokenizer.encode_batch_fast(sample, add_special_tokens=False)] == codec.reference.encode(sample)
