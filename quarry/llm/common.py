"""Helpers shared by the operators: scratch tables, word batches, hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir
from quarry.sources.tables import read_table

#: Bytes of text handled at once inside a task; longer single texts form a batch of their own.
SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


class Scratch:
    """Tables and files of one run, under the shared checkpoint folder.

    ``store`` cuts lineage by writing a Parquet table and reading it back;
    ``finish`` checkpoints the (small) result and deletes everything else.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def delete(self, name: str | None = None) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        hadoop.getFileSystem(conf).delete(hadoop, True)

    def finish(self, result: DataFrame) -> DataFrame:
        out = result.checkpoint(eager=True)
        self.delete()
        return out


def training_row(doc_id: Column, modulus: int, left_out: int) -> Column:
    """Whether a row may be learned from: crc32(doc_id as text) mod ``modulus``
    is not ``left_out``; a null id is never learned from."""
    return F.coalesce(remainder(doc_id, modulus) != left_out, F.lit(False))


def remainder(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit("")).alias(column)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``max_bytes`` of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // max_bytes
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)
            pa.default_memory_pool().release_unused()  # a worker outlives many tasks


@dataclass
class Words:
    """The words of a batch of texts: ``vocab`` holds the distinct words,
    ``idx`` the position in it of every word in order, ``lens`` the number of
    words of each text and ``starts`` their first positions."""

    vocab: pa.Array
    idx: np.ndarray
    lens: np.ndarray
    starts: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        """For every word the number of its text in the batch."""
        return np.repeat(np.arange(len(self.lens)), self.lens)


def words_of(texts: pa.Array, lower_ascii: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none)."""
    texts = pc.fill_null(texts, "")
    if lower_ascii:
        texts = pc.ascii_lower(texts)
    return _words(pc.ascii_split_whitespace(texts))


#: ASCII letters in lower case, digits and underscores; 0 for other ASCII characters; bytes of all others as they are.
_LEXICAL = bytes(ord(chr(b).lower()) if chr(b).isalnum() or chr(b) == "_" else 0 for b in range(128)) + bytes(range(128, 256))


def lexical_words_of(texts: pa.Array) -> Words:
    """Lower-case runs of letters, digits and underscores (Unicode ``\\w+``).

    The texts are cut at ASCII characters by their bytes; of the distinct parts
    only those with other characters are lowered and cut by the pattern."""
    parts = _ascii_parts(pc.fill_null(texts.cast(pa.large_string()), ""))
    wide = pc.invert(pc.string_is_ascii(parts.vocab)).to_numpy(zero_copy_only=False)
    if not wide.any():
        return parts
    words = _words(pc.split_pattern_regex(pc.utf8_lower(parts.vocab.filter(pa.array(wide))), r"[^\pL\pN\pM_]+"))
    lens = np.ones(len(wide), np.int64)
    lens[wide] = words.lens
    starts = np.cumsum(lens) - lens
    source = np.zeros(lens.sum(), np.int64)
    source[starts[~wide]] = np.flatnonzero(~wide)
    source[ragged(starts[wide], words.lens)] = len(wide) + words.idx
    # the words of all distinct parts in order, so words are numbered as they first occur
    code = pc.dictionary_encode(pa.concat_arrays([parts.vocab, words.vocab]).take(pa.array(source)))
    of_part = lens[parts.idx]
    idx = code.indices.to_numpy()[ragged(starts[parts.idx], of_part)]
    counts = per_text(of_part, parts.starts, parts.lens)
    return Words(code.dictionary, idx, counts, np.cumsum(counts) - counts)


def _ascii_parts(texts: pa.LargeStringArray) -> Words:
    """The parts of each text between ASCII characters that are in no word, those in words in lower case."""
    bounds, data = _bytes_of(texts)
    data = np.frombuffer(data.translate(_LEXICAL), np.uint8)
    inside = data != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    at = np.flatnonzero(first)
    offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - at)]).astype(np.int32)
    parts = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    code = pc.dictionary_encode(parts)
    of_text = np.searchsorted(at, bounds)
    return Words(code.dictionary, code.indices.to_numpy(), np.diff(of_text), of_text[:-1])


def _bytes_of(strings: pa.LargeStringArray) -> tuple[np.ndarray, bytes]:
    """The bytes of strings without nulls, joined, and where each begins and the last ends."""
    if not len(strings):
        return np.zeros(1, np.int64), b""
    _, offsets, data = strings.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(strings) + 1, strings.offset * 8)
    size = int(bounds[-1] - bounds[0])
    return bounds - bounds[0], data.slice(int(bounds[0]), size).to_pybytes() if size else b""


def _words(split: pa.ListArray) -> Words:
    flat = split.flatten()
    full = pc.not_equal(pc.binary_length(flat), 0)
    offsets = split.offsets.to_numpy()
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    bounds = kept[offsets - offsets[0]]
    code = pc.dictionary_encode(flat.filter(full))
    return Words(code.dictionary, code.indices.to_numpy(zero_copy_only=False), np.diff(bounds), bounds[:-1])


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lens[i] - 1`` for all i, joined."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.repeat(starts - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens)
    return first + np.arange(total)


def per_text(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each text (0 for an empty one)."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[starts + lens] - sums[starts]


def hash_words(vocab: pa.Array, seed: int = 0) -> np.ndarray:
    """Stable 64-bit hash of every word of a vocabulary."""
    digest = xxhash.xxh64_intdigest
    bounds, data = _bytes_of(vocab.cast(pa.large_string()))
    at = bounds.tolist()
    return np.fromiter((digest(data[a:b], seed) for a, b in zip(at, at[1:], strict=False)), np.uint64, len(vocab))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mixing hash (the published splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def record_batch(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
