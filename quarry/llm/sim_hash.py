"""SimHash classes by tiled exact comparison (operator 13).

Texts are lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and 4-word
shingles, repeats included.  A fingerprint bit is set if it is set in over half
of the shingles' XXH64 values.  Fingerprints of at most ``radius`` differing
bits are linked, and classes are the connected parts of the links.

Method: the distinct fingerprints are ordered by population counts (of the two
halves, the quarters, the bytes) and cut into tiles of at most ``TILE``
fingerprints, each with the least and greatest population count of every byte.
Two fingerprints differ in at least as many bits as the population counts of
their parts differ, summed over the parts.  So a tile meets only tiles whose
halves' counts lie within the radius (an equi-join on the pair of counts, 41
neighbours), and of these only tiles whose byte counts can lie within it.  The
more fingerprints there are, the narrower the tiles and the more pairs are
skipped.  Surviving pairs are compared exactly by exclusive-or and bit counts
in blocks of a few thousand values, and each gives a spanning forest of its
links, never the pairs themselves: a tile pair returns fewer links than it has
fingerprints, and connections stay whole.

Shuffles: (doc_id, fingerprint) rows, the distinct fingerprints, tile bounds,
and 16 KB a tile of each surviving pair.  Nothing is broadcast but the class of
the fingerprints that hold over 1/1000 of the rows each (under 1,000 rows).
No task holds more than a slice of text, a tile pair or a block of a stream.

Results: every row of the table gives one row, whatever its id.  A null text
is empty; texts without words have fingerprint zero, linked like any other.
``component_id`` is the least id of the class, null ids left aside (null where
a class has no other).  Repeated rows repeat; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.llm.common import Scratch, ragged, record_batch, slices
from quarry.llm.components import components

WORDS_PER_SHINGLE = 4
RADIUS = 4
SEED = 42  # fixed value of the contract

#: Fingerprints in a tile, and rows of it compared at once.
TILE = 2048
BLOCK = 64
#: A fingerprint with more than this share of the rows is hot.
HOT_SHARE = 1000

_LANES = np.uint64(0x0001000100010001)
_PIECE = 32_768  # a 16-bit lane counts so many values safely


def near_classes(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id, component_rows, copies): per row the
    hexadecimal fingerprint, the least id of its class, the rows of the class
    and the rows of the same fingerprint."""
    scratch = Scratch(docs.sparkSession)
    prints = scratch.store(fingerprints(docs), "prints")
    contents = scratch.store(prints.groupBy("fingerprint").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least")), "contents")
    edges = scratch.store(links(contents.select("fingerprint"), scratch, radius), "links")
    roots = components(edges, scratch, "parts").select(F.col("node").alias("fingerprint"), "root")
    rooted = contents.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    parts = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("copies").alias("component_rows"))
    classes = scratch.store(rooted.join(parts, "root").select("fingerprint", "copies", "component_id", "component_rows"), "classes")

    rows = prints.count()
    hot = F.col("copies") * HOT_SHARE > F.lit(rows)
    frequent = F.broadcast(classes.filter(hot).withColumn("hot", F.lit(True)))  # under HOT_SHARE rows
    marked = prints.join(frequent, "fingerprint", "left")
    names = ["doc_id", "fingerprint", "component_id", "component_rows", "copies"]
    rest = marked.filter("hot is null").select("doc_id", "fingerprint").join(classes.filter(~hot), "fingerprint")
    out = marked.filter("hot").select(names).unionByName(rest.select(names))
    return scratch.finish(out.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint): the 64 bits of every text as a long; map-only."""
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("fingerprint", LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bits = simhash(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits.view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def simhash(texts: pa.Array) -> np.ndarray:
    """The fingerprints of a batch of texts as unsigned 64-bit integers."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, offsets = split.flatten(), split.offsets.to_numpy()
    full = pc.not_equal(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    bounds = kept[offsets - offsets[0]]
    words = flat.filter(full)
    first, n_words = bounds[:-1], np.diff(bounds)
    # all words joined by one space: a shingle is a stretch of that text
    ends = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_buffer().to_pybytes()
    n = np.where(n_words >= WORDS_PER_SHINGLE, n_words - WORDS_PER_SHINGLE + 1, np.minimum(n_words, 1))
    last = np.minimum(n_words, WORDS_PER_SHINGLE) - 1
    at = ragged(first, n)
    a, b = starts[at].tolist(), ends[at + np.repeat(last, n)].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(a, b, strict=True)), np.uint64, len(a))
    return _majority(hashes, n)


def _majority(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per text the bits set in over half of its ``n`` hashes (none: zero)."""
    out = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    m = n[some]
    pieces = -(-m // _PIECE)
    first_piece = np.cumsum(pieces) - pieces
    text_start = np.cumsum(m) - m
    inner = ragged(np.zeros(len(m), np.int64), pieces)
    cuts = np.repeat(text_start, pieces) + inner * _PIECE
    for shift in range(16):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _LANES, cuts)
        for lane in range(4):
            counts = np.add.reduceat(((lanes >> np.uint64(16 * lane)) & np.uint64(0xFFFF)).astype(np.int64), first_piece)
            out[some] |= (counts * 2 > m).astype(np.uint64) << np.uint64(16 * lane + shift)
    return out


def links(contents: DataFrame, scratch: Scratch, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints within the radius."""
    tiles = scratch.store(_tiles(contents), "tiles")
    pairs = scratch.store(_tile_pairs(tiles, radius), "tile-pairs")
    body = tiles.select("tile", "prints")
    left = pairs.join(body.withColumnRenamed("tile", "t1").withColumnRenamed("prints", "p1"), "t1")
    both = left.join(body.withColumnRenamed("tile", "t2").withColumnRenamed("prints", "p2"), "t2")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same, p1, p2 in zip(batch.column("same").to_pylist(), batch.column("p1"), batch.column("p2"), strict=True):
                a = np.frombuffer(p1.as_buffer(), np.uint64)
                b = a if same else np.frombuffer(p2.as_buffer(), np.uint64)
                found = forest(a, b, same, radius)
                if len(found):
                    yield record_batch(schema, [found[:, 0].copy().view(np.int64), found[:, 1].copy().view(np.int64)])

    return both.select((F.col("t1") == F.col("t2")).alias("same"), "p1", "p2").mapInArrow(run, "a long, b long")


def _part_count(column: str, part: int, width: int) -> Column:
    """Population count of one part of ``width`` bits."""
    return F.bit_count(F.shiftrightunsigned(column, part * width).bitwiseAND(F.lit((1 << width) - 1)))


def _tiles(contents: DataFrame) -> DataFrame:
    """(tile, high, low, least, most, prints): at most ``TILE`` fingerprints of
    equal counts in both halves; ``tile`` is the first of them, ``least`` and
    ``most`` bound the count of every byte, ``prints`` packs the values."""
    counted = contents.select(
        "fingerprint",
        _part_count("fingerprint", 1, 32).alias("high"),
        _part_count("fingerprint", 0, 32).alias("low"),
        *[_part_count("fingerprint", i, 16).alias(f"q{i}") for i in (3, 1)],
        *[_part_count("fingerprint", i, 8).alias(f"b{i}") for i in (7, 5, 3, 1)],
    )
    order = ["high", "low", "q3", "q1", "b7", "b5", "b3", "b1", "fingerprint"]
    schema = "tile long, high int, low int, least array<int>, most array<int>, prints binary"
    out = pa.schema([
        ("tile", pa.int64()), ("high", pa.int32()), ("low", pa.int32()),
        ("least", pa.list_(pa.int32())), ("most", pa.list_(pa.int32())), ("prints", pa.binary()),
    ])

    def rows(prints: np.ndarray, cell: np.ndarray) -> Iterator[pa.RecordBatch]:
        counts = np.bitwise_count(prints.view(np.uint8)).reshape(-1, 8).astype(np.int32)
        edges = np.flatnonzero(np.diff(cell)) + 1
        cuts = [c for a, b in zip([0, *edges], [*edges, len(cell)], strict=True) for c in range(a, b, TILE)]
        ends = [*cuts[1:], len(cell)]
        yield record_batch(out, [
            prints[cuts].view(np.int64), (cell[cuts] // 64).astype(np.int32), (cell[cuts] % 64).astype(np.int32),
            [counts[a:b].min(0) for a, b in zip(cuts, ends, strict=True)],
            [counts[a:b].max(0) for a, b in zip(cuts, ends, strict=True)],
            [prints[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)],
        ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, kept_cell = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            cell = batch.column("high").to_numpy().astype(np.int64) * 64 + batch.column("low").to_numpy()
            prints = np.concatenate([kept, batch.column("fingerprint").to_numpy().view(np.uint64)])
            cell = np.concatenate([kept_cell, cell])
            if not len(cell):
                continue
            # hold back the unfinished tile of the last cell
            start = int(np.searchsorted(cell, cell[-1]))
            done = start + (len(cell) - start) // TILE * TILE
            if done:
                yield from rows(prints[:done], cell[:done])
            kept, kept_cell = prints[done:], cell[done:]
        if len(kept):
            yield from rows(kept, kept_cell)

    ordered = counted.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("fingerprint", "high", "low").mapInArrow(run, schema)


def _tile_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """(t1, t2): every pair of tiles, each with itself too, that can hold
    fingerprints within the radius by their population counts."""
    steps = [(i, j) for i in range(radius + 1) for j in range(-radius, radius + 1) if i + abs(j) <= radius and (i, j) >= (0, 0)]
    bounds = tiles.select("tile", "high", "low", "least", "most")
    near = bounds.select(
        F.col("tile").alias("t1"), F.col("least").alias("least1"), F.col("most").alias("most1"),
        F.inline(F.array(*[F.struct((F.col("high") + i).alias("high"), (F.col("low") + j).alias("low"), F.lit((i, j) == (0, 0)).alias("own")) for i, j in steps])),
    )
    gaps = [
        F.greatest(F.col("least")[i] - F.col("most1")[i], F.col("least1")[i] - F.col("most")[i], F.lit(0)) for i in range(8)
    ]
    met = near.join(bounds.withColumnRenamed("tile", "t2"), ["high", "low"])
    return met.filter((sum(gaps[1:], gaps[0]) <= radius) & (~F.col("own") | (F.col("t1") <= F.col("t2")))).select("t1", "t2")


def forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int = RADIUS) -> np.ndarray:
    """Links of a spanning forest of all pairs of ``a`` and ``b`` (or within
    ``a``) that differ in at most ``radius`` bits: rows (value, value)."""
    shift = 0 if same else len(a)
    label = np.arange(len(a) + (0 if same else len(b)))
    found = []
    for start in range(0, len(a), BLOCK):
        from_b = start if same else 0
        near = np.bitwise_count(a[start : start + BLOCK, None] ^ b[None, from_b:]) <= radius
        i, j = np.nonzero(near)
        i, j = i + start, j + from_b
        li, lj = label[i], label[j + shift]
        other = li != lj
        if not other.any():
            continue
        i, j, li, lj = i[other], j[other], li[other], lj[other]
        key = np.minimum(li, lj) * len(label) + np.maximum(li, lj)
        _, once = np.unique(key, return_index=True)
        top: dict[int, int] = {}

        def root(x: int) -> int:
            while x in top:
                x = top[x]
            return x

        for k in once.tolist():
            x, y = root(int(li[k])), root(int(lj[k]))
            if x != y:
                top[max(x, y)] = min(x, y)
                found.append((a[i[k]], b[j[k]]))
        moved = np.arange(len(label))
        for x in top:
            moved[x] = root(x)
        label = moved[label]
    return np.array(found, np.uint64).reshape(-1, 2)
