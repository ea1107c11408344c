"""Operator 3: token ids in fixed-width bit-packed binary files.

``write_packed`` encodes every text with a tokenizer of the tokenizers
library, appends an end id, and writes the ids in ascending ``doc_id`` order,
one binary file a range of ids.  Each id takes the minimum number of bits of
the vocabulary; ids lie in blocks of ``BLOCK`` ids, whose byte offsets stand
in the footer, so any range of ids is read by unpacking its blocks alone, as
whole numpy columns (64 ids of ``w`` bits fill ``w`` 64-bit words exactly).

    file   := MAGIC, block*, footer, footer offset (u64), MAGIC
    block  := w * BLOCK / 64 little-endian 64-bit words
    footer := width, n_docs, n_ids, n_blocks (u64 each),
              block offsets (u64, n_blocks + 1), doc starts (i64, n_docs + 1),
              doc ids (i64, n_docs), doc id is null (u8, n_docs)

Scale: one range shuffle of the texts (sampled bounds, so no partition holds
much more than the others; rows of equal id are spread by the hash of their
text), one pass over them, and one distributed pass over the files.  A task
streams its blocks and keeps only the footer.  Files are written under an
attempt's own name and then renamed, so a repeated task leaves one good file.

Defined results: a null or empty text has the end id alone; rows of equal id
are ordered by the hash of their text and all kept; rows of null id come
first; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import json
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, ragged, record_batch, slices, text_of, words_of

MAGIC = b"QPACKED1"
BLOCK = 4096
#: Words kept with their ids in a worker; beyond that the cache starts anew.
CACHE_WORDS = 400_000
#: Text encoded at once in a task: more of it has fewer new words a word.
ENCODED_BYTES = 12 << 20
#: The shape of a tokenizer whose words can be encoded one by one
#: (white space separates words and leaves no trace, letters are lower-cased).
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same pattern over lower-cased words of printable ASCII and Latin-1 letters.
PLAIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
PLAIN_WORD = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def _byte_chars() -> dict[int, str]:
    """Byte-level alphabet: visible Latin-1 characters stand for their own
    byte, the other bytes in order for the characters from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + n) for n, b in enumerate(hidden)}


BYTE_CHARS = _byte_chars()


# -- bit packing -----------------------------------------------------------


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> np.ndarray:
    """Ids (a multiple of 64 of them) as little-endian 64-bit words."""
    rows = ids.astype(np.uint64).reshape(-1, 64)
    out = np.zeros((len(rows), width), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[:, word] |= rows[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= rows[:, j] >> np.uint64(64 - shift)
    return out.ravel().astype("<u8")


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    rows = words.astype(np.uint64).reshape(-1, width)
    out = np.empty((len(rows), 64), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        x = rows[:, word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (rows[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = x & np.uint64((1 << width) - 1)
    return out.ravel().astype(np.uint32)


class PackedWriter:
    """Streams ids into one file; call ``add`` for documents in order, then ``close``."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.out.write(MAGIC)
        self.at, self.offsets = len(MAGIC), [len(MAGIC)]
        self.rest = np.zeros(0, np.uint32)
        self.doc_ids, self.nulls, self.lens = [], [], []

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, lens: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_ids), self.nulls.append(nulls), self.lens.append(lens)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK * BLOCK
        self._blocks(ids[:whole])
        self.rest = ids[whole:]

    def _blocks(self, ids: np.ndarray) -> None:
        if len(ids):
            self.out.write(pack(ids, self.width).tobytes())
            size = self.width * BLOCK // 8
            for _ in range(len(ids) // BLOCK):
                self.at += size
                self.offsets.append(self.at)

    def close(self) -> tuple[int, int]:
        lens = np.concatenate([np.zeros(0, np.int64), *self.lens])
        if len(self.rest):
            self._blocks(np.concatenate([self.rest, np.zeros(BLOCK - len(self.rest), np.uint32)]))
        head = np.array([self.width, len(lens), lens.sum(), len(self.offsets) - 1], "<u8")
        for part in (
            head,
            np.array(self.offsets, "<u8"),
            np.concatenate([[0], np.cumsum(lens)]).astype("<i8"),
            np.concatenate([np.zeros(0, np.int64), *self.doc_ids]).astype("<i8"),
            np.concatenate([np.zeros(0, np.uint8), *self.nulls]).astype("u1"),
        ):
            self.out.write(part.tobytes())
        self.out.write(np.array([self.at], "<u8").tobytes() + MAGIC)
        self.out.close()
        return len(lens), int(lens.sum())


class PackedFile:
    """Random access to one packed file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        tail = source.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError("not a packed file, or cut short")
        at = int(np.frombuffer(tail[:8], "<u8")[0])
        body = source.read_at(size - 16 - at, at)
        self.width, n_docs, self.n_ids, n_blocks = (int(x) for x in np.frombuffer(body, "<u8", 4))
        at = 32
        self.offsets = np.frombuffer(body, "<u8", n_blocks + 1, at)
        at += 8 * (n_blocks + 1)
        self.starts = np.frombuffer(body, "<i8", n_docs + 1, at)
        at += 8 * (n_docs + 1)
        self.doc_ids = np.frombuffer(body, "<i8", n_docs, at)
        self.nulls = np.frombuffer(body, "u1", n_docs, at + 8 * n_docs)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from position ``start`` to ``end`` (exclusive)."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (end - 1) // BLOCK + 1
        a, b = int(self.offsets[first]), int(self.offsets[last])
        ids = unpack(np.frombuffer(self.source.read_at(b - a, a), "<u8"), self.width)
        return ids[start - first * BLOCK : end - first * BLOCK]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


# -- encoding --------------------------------------------------------------


class WordEncoder:
    """Ids of whole texts, with each distinct word encoded once a worker.

    For a tokenizer of the shape above no token spans white space, so a text's
    ids are the joined ids of its words.  Words of printable ASCII and Latin-1
    letters go piece by piece straight to the library's BPE model, the others
    through its whole pipeline; a tokenizer of another shape, or a word holding a special
    token's string, is encoded as a whole text.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        parts = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = parts == WORD_NORMALIZERS and [p.get("type") for p in pre] == ["Split", "ByteLevel"] and pre[0]["pattern"].get("Regex") == WORD_PATTERN
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.model = self.tokenizer.model
        self.cache_words = cache_words
        self.words: dict[str, bytes] = {}

    def _plain(self, piece: str) -> bytes:
        """Ids of a lower-case piece the pre-tokenizer leaves whole."""
        chars = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_CHARS)
        return array("I", [t.id for t in self.model.tokenize(chars)]).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Put the ids of words that are not known yet into the cache."""
        other, known, plain = [], self.words, self._plain
        for w in words:
            if w.isascii() and w.isalpha() and w.islower():
                known[w] = plain(w)
            elif PLAIN_WORD.fullmatch(w) and not any(s in w for s in self.special):
                known[w] = b"".join([plain(p) for p in PLAIN_PIECES.findall(w.lower())])
            else:
                other.append(w)
        for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            known[w] = array("I", e.ids).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts joined, and the number of ids of each."""
        if not self.by_word:
            got = [e.ids for e in self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            lens = np.array([len(g) for g in got], np.int64)
            return np.array([i for g in got for i in g], np.uint32), lens
        if not any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.special):
            # fewer distinct words: the pipeline itself lower-cases and parts letters from marks
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), r"(\pL)([.,]+)(\s)", r"\1 \2\3")
        w = words_of(texts)
        vocab = w.vocab.to_pylist()
        missing = [x for x in vocab if x not in self.words]
        if missing and len(self.words) + len(missing) > self.cache_words:
            self.words = {x: self.words[x] for x in vocab if x in self.words}
        self._learn(missing)
        blobs = [self.words[x] for x in vocab]
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        flat = np.frombuffer(b"".join(blobs), "<u4")
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
        each = sizes[w.idx]
        bounds = np.concatenate([[0], np.cumsum(each)])
        return flat[ragged(first[w.idx], each)], bounds[w.starts + w.lens] - bounds[w.starts]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# -- Spark side ------------------------------------------------------------

MANIFEST = pa.schema([("shard", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
MANIFEST_DDL = "shard long, file string, n_docs long, n_ids long"


def write_packed(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, shards: int | None = None) -> DataFrame:
    """Write ``docs`` (doc_id, text) as packed files in ``folder`` (a URI that
    pyarrow's file systems reach, shared by all executors).

    Returns the lazy manifest (one row a file: shard, file, n_docs, n_ids);
    the files are written as it is computed.  ``shards`` fixes the number of
    files; by default it follows ``spark.sql.shuffle.partitions``, with small
    neighbours merged at run time.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer, enc = TaskContext.get().partitionId(), None, encoder(tokenizer)
        width = width_of(max(enc.tokenizer.get_vocab_size(), end_id + 1))
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in slices(batches, max_bytes=ENCODED_BYTES):
            if writer is None:
                fs.create_dir(root, recursive=True)
                draft = f"{root}/.{shard:08d}-{uuid.uuid4().hex}"
                writer = PackedWriter(fs.open_output_stream(draft), width)
            ids, lens = enc.encode(batch.column(1))
            ends = np.cumsum(lens)
            ids = np.insert(ids, ends, end_id)
            doc_ids = batch.column(0)
            writer.add(doc_ids.fill_null(0).to_numpy(), doc_ids.is_null().to_numpy(zero_copy_only=False), lens + 1, ids)
        if writer is not None:
            n_docs, n_ids = writer.close()
            name = f"{shard:08d}.ids"
            fs.move(draft, f"{root}/{name}")
            yield record_batch(MANIFEST, [[shard], [name], [n_docs], [n_ids]])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of())
    order = ["doc_id", F.xxhash64("text")]
    ranged = rows.repartitionByRange(shards, *order) if shards else rows.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).mapInArrow(write, MANIFEST_DDL)


READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("shard", pa.int64())])
READ_DDL = "doc_id long, start long, n_tokens long, ids_crc32 long, shard long"


def read_packed(manifest: DataFrame, folder: str, batch_ids: int = 1 << 20) -> DataFrame:
    """One row a document of the files of ``manifest``: doc_id, start (ids of
    all documents before it), n_tokens, ids_crc32 (of its ids as little-endian
    unsigned 32-bit integers) and shard.  The manifest has one row a file, so
    its running total is small; each file is a task's, however small the
    manifest."""
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("base", before)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/{row['file']}") as source:
                    f = PackedFile(source)
                    n = len(f.doc_ids)
                    a = 0
                    while a < n:  # as many documents as fit, one at least
                        b = max(a + 1, int(np.searchsorted(f.starts, f.starts[a] + batch_ids, "right")) - 1)
                        ids = f.ids(int(f.starts[a]), int(f.starts[b])).astype("<u4")
                        at = f.starts[a : b + 1] - f.starts[a]
                        crc = [zlib.crc32(ids[at[i] : at[i + 1]].tobytes()) for i in range(b - a)]
                        doc_ids = pa.array(f.doc_ids[a:b], mask=f.nulls[a:b].astype(bool))
                        yield record_batch(READ, [doc_ids, f.starts[a:b] + row["base"], np.diff(at), crc, np.full(b - a, row["shard"])])
                        a = b

    return files.repartitionByRange(max(1, manifest.count()), "shard").mapInArrow(read, READ_DDL)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the packed files of ``docs`` in scratch space, read them back and
    return what they hold (see ``read_packed``)."""
    scratch = Scratch(docs.sparkSession)
    folder = scratch.path("ids")
    manifest = scratch.store(write_packed(docs, folder, tokenizer, end_id), "manifest")
    return scratch.finish(read_packed(manifest, folder).drop("shard"))
