"""Operator 1: SentencePiece encoding and decoding on the tokenizers library.

``read_model`` parses the model file's protobuf wire format; ``rebuild`` makes
a tokenizers-library tokenizer from it: the normaliser (precompiled character
map, extra-space removal, dummy prefix, metaspace marker), the model (unigram
scores, or for BPE files the merges that the scores order), byte fallback and
the decoder.  ``Codec`` encodes and decodes batches with the library's threads
and verifies parity with the sentencepiece library on everything it encodes.

A text is cut before each run of spaces when that is provably exact (no
normaliser map, no user-defined pieces, and no piece of the vocabulary holds
the space marker behind another character), so each distinct unit is encoded
and verified once a worker; other models encode whole texts, each verified.
Where the two libraries differ (BPE files can give one piece two merge orders)
the reference library's ids are used and the row's ``parity`` is false.

Scale: map-only, no shuffle; a task holds one batch cut by bytes and a bounded
cache of units.

Defined results: null and empty texts have no ids and decode to the empty
text; every row gives a row; an empty table gives none.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import _words, ragged, record_batch, slices

# Piece types, model types and field numbers of the model file's public schema.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"
#: Units kept with their ids in a worker; beyond that the cache starts anew from the batch at hand.
CACHE_UNITS = 120_000


# -- the model file --------------------------------------------------------


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; floats stay 4 raw bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"unknown wire type {wire}")
        yield key >> 3, value


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True


def read_model(path: str) -> Model:
    with open(path, "rb") as f:
        data = f.read()
    model = Model()
    for number, value in fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            spec = dict(fields(value))
            model.kind = spec.get(3, UNIGRAM)
            model.byte_fallback = bool(spec.get(35, 0))
        elif number == 3:
            spec = dict(fields(value))
            model.charsmap = spec.get(2, b"")
            model.dummy_prefix = bool(spec.get(3, 1))
            model.remove_extra_spaces = bool(spec.get(4, 1))
            model.escape_spaces = bool(spec.get(5, 1))
    model.unk_id = next(i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN)
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    return model


def merges_of(model: Model) -> list[tuple[str, str]]:
    """Every split of a piece into two pieces, best merged score first."""
    score = {p: s for p, s, kind in model.pieces if kind == NORMAL}
    order = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    found = []
    for piece, s in score.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in score and right in score:
                found.append((-s, order[piece], order[left], order[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def rebuild(model: Model):
    """The tokenizers-library tokenizer of a model, or a ValueError."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    else:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab, merges_of(model), unk_token=model.pieces[model.unk_id][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    user = [p for p, _, kind in model.pieces if kind == USER_DEFINED]
    if user:
        tokenizer.add_tokens([AddedToken(p, normalized=False) for p in user])
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer


# -- batches ---------------------------------------------------------------


class Codec:
    """Batch encoder and decoder of one model file, verified against the reference library."""

    def __init__(self, path: str, threads: int = 2, cache_units: int = CACHE_UNITS):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        import sentencepiece

        self.model = read_model(path)
        self.tokenizer = rebuild(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [p for p, _, kind in self.model.pieces if kind in (NORMAL, UNUSED)]
        self.by_unit = (
            self.model.kind == BPE
            and not self.model.charsmap
            and self.model.dummy_prefix
            and self.model.escape_spaces
            and not self.model.remove_extra_spaces
            and not any(kind in (USER_DEFINED, UNUSED) for *_, kind in self.model.pieces)
            and not any(re.search(f"[^{MARK}]{MARK}", p) for p in normal)
            and not any("\n" in p for p in normal)
        )
        self.line_ids = self._plain("\n")
        self.ends = {c: self._plain(c) for c in ".,"}
        self.joined = {p[i : i + 2] for p in normal for i in range(len(p) - 1) if p[i + 1] in self.ends}
        self.cache_units = cache_units
        self.units: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}
        self.unequal: set[str] = set()
        self.id_bytes = None

    def _plain(self, escaped: str) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(escaped)]).tobytes()

    def _learn(self, units: list[str]) -> None:
        """Encode units and verify them.  A unit is what follows one space of
        the text; one that begins with a line feed follows no space."""
        stems = {self._stem(u) for u in units}
        stems = [u for u in stems if u not in self.stems]
        if len(self.stems) + len(stems) > self.cache_units:
            self.stems = {u: self.stems[u] for u in map(self._stem, units) if u in self.stems}
        for stem, want in zip(stems, self.reference.encode(stems, num_threads=1), strict=True):
            got = self._plain(MARK) + self.line_ids + self._plain(stem[1:]) if stem[:1] == "\n" else self._plain(MARK + stem)
            want = array("I", want).tobytes() if stem else got  # the reference drops an empty text
            if got != want:
                self.unequal.add(stem)
            self.stems[stem] = want[4:] if stem[:1] == "\n" else want
        for u in units:
            stem = self._stem(u)
            self.units[u] = self.stems[stem] if stem == u else self.stems[stem] + self.ends[u[-1]]

    def _stem(self, unit: str) -> str:
        """The unit without a last mark that no piece joins to what stands before it."""
        if len(unit) > 1 and unit[-1] in self.ends and unit[-2:] not in self.joined:
            return unit[:-1]
        return unit

    def _whole(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        got = [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        want = [array("I", ids).tobytes() for ids in self.reference.encode(texts, num_threads=1)] if texts else []
        return want, [g == w for g, w in zip(got, want, strict=True)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids joined, the number of ids of each text, and whether both libraries agree on it."""
        texts = pc.fill_null(texts, "")
        plain = np.zeros(len(texts), bool)
        if self.by_unit:
            odd = pc.or_(pc.match_substring_regex(texts, " [ \\n]|^[ \\n]| $"), pc.equal(texts, ""))
            plain = ~odd.to_numpy(zero_copy_only=False)
        n, ok = np.zeros(len(texts), np.int64), np.ones(len(texts), bool)
        odd_at = np.flatnonzero(~plain)
        odd_ids, odd_ok = self._whole(texts.take(pa.array(odd_at)).to_pylist())
        n[odd_at] = [len(b) // 4 for b in odd_ids]
        ok[odd_at] = odd_ok
        at = np.flatnonzero(plain)
        if not len(at):
            return np.frombuffer(b"".join(odd_ids), "<u4"), n, ok
        w = _words(pc.split_pattern(pc.replace_substring(texts.filter(pa.array(plain)), "\n", " \n"), " "))
        vocab = w.vocab.to_pylist()
        missing = [u for u in vocab if u not in self.units]
        if missing and len(self.units) + len(missing) > self.cache_units:
            self.units = {u: self.units[u] for u in vocab if u in self.units}
        self._learn(missing)
        blobs = [self.units[u] for u in vocab]
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        first = np.cumsum(sizes) - sizes
        each = sizes[w.idx]
        bounds = np.concatenate([[0], np.cumsum(each)])
        ids = np.frombuffer(b"".join(blobs), "<u4")[ragged(first[w.idx], each)]
        n[at] = bounds[w.starts + w.lens] - bounds[w.starts]
        if self.unequal:
            bad = np.fromiter((self._stem(u) in self.unequal for u in vocab), bool, len(vocab))[w.idx]
            ok[at] = np.add.reduceat(bad, w.starts) == 0 if len(bad) else True
        if len(odd_at):  # put the texts back in order
            out = np.empty(int(n.sum()), np.uint32)
            begin = np.cumsum(n) - n
            out[ragged(begin[at], n[at])] = ids
            out[ragged(begin[odd_at], n[odd_at])] = np.frombuffer(b"".join(odd_ids), "<u4")
            ids = out
        return ids, n, ok

    def decode(self, ids: np.ndarray, lens: np.ndarray) -> list[str]:
        """Texts of joined ids.  The bytes that the library's decoder gives
        each id are gathered as one column; a text they do not make valid
        UTF-8 of goes through the decoder itself."""
        if self.id_bytes is None:
            self.id_bytes = pa.array([self._bytes(i) for i in range(len(self.model.pieces))], pa.binary())
        flat = self.id_bytes.take(pa.array(ids.astype(np.int32)))
        sizes = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
        joined = b"".join(flat.to_pylist()) if flat.offset else flat.buffers()[2].to_pybytes() if len(flat) else b""
        at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(lens)])].tolist()
        ends, out = np.cumsum(lens).tolist(), []
        for k, (a, b) in enumerate(zip(at, at[1:], strict=False)):
            a += int(self.model.dummy_prefix and joined[a:b][:1] == b" ")
            try:
                out.append(joined[a:b].decode())
            except UnicodeDecodeError:
                out.append(self.tokenizer.decode(ids[ends[k] - lens[k] : ends[k]].tolist(), skip_special_tokens=False))
        return out

    def _bytes(self, i: int) -> bytes:
        piece, _, kind = self.model.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        lead = self.tokenizer.decode([i, i], skip_special_tokens=False)
        return lead[len(lead) - len(piece) :].encode()  # the second copy keeps its leading space


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


# -- Spark side ------------------------------------------------------------


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, token_ids (array of int) and parity of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("token_ids", pa.list_(pa.int32())), ("parity", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, lens, ok = codec(model_path).encode(batch.column(1))
            offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
            yield record_batch(schema, [batch.column(0), lens, pa.ListArray.from_arrays(offsets, ids.astype(np.int32)), ok])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, token_ids array<int>, parity boolean")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of every row of (doc_id, token_ids); null ids decode to the empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield record_batch(schema, [batch.column(0), codec(model_path).decode(lists.flatten().to_numpy(zero_copy_only=False), lens)])

    return encoded.select("doc_id", "token_ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Encode every text, decode its ids, and report both: doc_id, n_tokens,
    ids_crc32 (little-endian unsigned 32-bit ids), decoded_sha256,
    round_trip (the decoded text equals the text) and parity."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_sha256", pa.string()), ("round_trip", pa.bool_()), ("parity", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            c = codec(model_path)
            ids, lens, ok = c.encode(batch.column(1))
            ends = np.cumsum(lens)
            raw = ids.astype("<u4")
            crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(ends - lens, ends, strict=True)]
            back = c.decode(ids, lens)
            digests = [hashlib.sha256(t.encode()).hexdigest() for t in back]
            same = pc.equal(pa.array(back, pa.string()), pc.fill_null(batch.column(1), ""))
            yield record_batch(schema, [batch.column(0), lens, crc, digests, same, ok])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean, parity boolean")
