"""Operator 9: near duplicates by improved consistent weighted sampling.

A text is the weighted set of its five-word shingles: a shingle's weight is
its count in the text times the mean inverse document frequency of its words.
Improved consistent weighted sampling (Ioffe 2010) draws ``SAMPLES`` samples
whose chance to agree is the weighted Jaccard similarity; ``BANDS`` bands of
them are the buckets of candidates, candidates are verified by their exact
weighted Jaccard similarity (0.8 or more), and the connected verified texts
form a class.

* Texts with equal words are one *content* (a 128-bit digest) from the start,
  so groups of copies of any size cost one row a copy.
* Document frequencies are counted over all documents; the words in at least
  one document in ``RARE`` are broadcast (at most ``RARE`` times the mean
  number of distinct words a document), all others have the largest weight.
* Buckets of up to ``SMALL`` contents give all their pairs.  In larger buckets
  every content first meets the bucket's head and its neighbours in groups of
  ``GROUP`` contents drawn by hash, which joins most of a class of near copies
  by few pairs.
* Candidates whose samples agree too rarely for a similarity of 0.8 (more than
  four standard errors below) are left out.  Of the rest, first the best pair
  of each content is verified; then all pairs that still join two classes are,
  so pairs inside one class need no verification.
* The rest of the larger buckets: all pairs of contents of one bucket that are
  not in one class by then are compared, in tiles of about ``TILE`` contents;
  large classes have tiles of their own, whose inner pairs are left out.  Pairs
  whose samples agree often enough are verified, a pair of tiles at a time.  So
  every two contents that share a bucket are compared or are of one class.
* Only the texts of contents with candidates are read again for that.

Scale: two map passes over the documents, shuffles of fixed-size rows a
content, and of the texts of candidate pairs.  Bucket statistics are combined
before their shuffles; joins on hot buckets or contents can be split at run
time.  A task of the rest holds a pair of tiles; their number grows with the
square of a bucket's contents outside its largest class.  Nothing but row
counts reaches the driver.

Defined results: texts of fewer than five words have one shingle of all their
words; texts without words (also null ones) are each a class of their own;
rows of equal id keep their rows; a null id is the least of its class only if
all its ids are null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, hash_words, lexical_words_of, mix, ragged, record_batch, slices, text_of
from quarry.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
SAMPLES, BANDS = 64, 16
ROWS = SAMPLES // BANDS
#: Agreement of samples below which a pair is not verified: 0.8 less 4.4 standard errors.
LEAST_AGREEMENT = 37
SMALL, GROUP = 16, 8
#: Contents, and bytes of their texts, of a tile of a larger bucket.
TILE, TILE_BYTES = 512, 2 << 20
RARE = 1000
#: Ids up to this number (8 bytes and a digest each) are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Shingles whose random numbers are drawn at once: their arrays stay in a core's cache.
CHUNK = 1 << 14
#: Text whose shingles are held at once in a task.
SIGNED_BYTES = 3 << 20


# -- weighted sets ---------------------------------------------------------


@dataclass
class Idf:
    words: np.ndarray  # sorted hashes of the words in at least one document in RARE
    values: np.ndarray
    largest: float

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(hashes), self.largest)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.values[at], self.largest)


@dataclass
class WeightedSets:
    """The distinct shingles of each text in ascending order of hash, with their weights."""

    shingles: np.ndarray
    weights: np.ndarray
    starts: np.ndarray
    lens: np.ndarray
    content: list[bytes | None]  # digest of each text's words; None without words


def weighted_sets(texts: pa.Array, idf: Idf) -> WeightedSets:
    w = lexical_words_of(texts)
    hashes = hash_words(w.vocab)
    word, idfs = hashes[w.idx], idf.of(hashes)[w.idx]
    content = [xxhash.xxh3_128_digest(word[a : a + n].tobytes()) if n else None for a, n in zip(w.starts.tolist(), w.lens.tolist(), strict=True)]
    n_shingles = np.where(w.lens >= SHINGLE, w.lens - SHINGLE + 1, np.minimum(w.lens, 1))
    code, weight = shingles_at(word, idfs, w.starts, w.lens)
    first = ragged(w.starts, n_shingles)
    code, weight = code[first], weight[first]
    doc = np.repeat(np.arange(len(w.lens)), n_shingles)
    ends = np.cumsum(n_shingles)
    order = np.empty(len(code), np.int64)
    for a, b in zip((ends - n_shingles).tolist(), ends.tolist(), strict=True):
        order[a:b] = code[a:b].argsort()
        order[a:b] += a
    code, weight = code[order], weight[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    # equal shingles have equal words, so count times weight is their sum
    total = np.add.reduceat(weight, at) if len(at) else weight
    lens = np.bincount(doc[at], minlength=len(w.lens))
    return WeightedSets(code[at], np.maximum(total, 1e-6), np.cumsum(lens) - lens, lens, content)


def shingles_at(word: np.ndarray, idfs: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and mean weight of the shingle that begins at each word: of
    SHINGLE words, in a shorter text of all its words."""
    n = len(word)
    word, idfs = (np.concatenate([x, np.zeros(SHINGLE - 1, x.dtype)]) for x in (word, idfs))
    code, weight = np.zeros(n, np.uint64), np.zeros(n)
    ended = []
    for k in range(SHINGLE):
        for a in range(0, n, CHUNK):
            b = min(a + CHUNK, n)
            code[a:b] = mix(code[a:b] + word[a + k : b + k])
            weight[a:b] += idfs[a + k : b + k]
        at = starts[lens == k + 1]
        ended.append((at, code[at], weight[at] / (k + 1)))
    weight /= SHINGLE
    for at, codes, weights in ended:
        code[at], weight[at] = codes, weights
    return code, weight


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two weighted sets (sorted shingles, weights)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][i], b[1][j]).sum() if len(common) else 0.0
    return float(least / (a[1].sum() + b[1].sum() - least))


# -- improved consistent weighted sampling ---------------------------------


def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of Gamma(2, 1) at (i + 0.5) / n: its distribution function is
    1 - exp(-x)(1 + x), inverted by bisection."""
    p = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 60.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - np.exp(-x) * (1 + x) < p
        low, high = np.where(below, x, low), np.where(below, high, x)
    return (low + high) / 2


GAMMA = _gamma_quantiles(1 << 16)
GAMMA_R, LOG_C = GAMMA.astype(np.float32), np.log(GAMMA).astype(np.float32)
SEEDS = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def samples(sets: WeightedSets) -> np.ndarray:
    """A row of SAMPLES 32-bit samples for each text (0 for one without shingles)."""
    out = np.zeros((len(sets.lens), SAMPLES), np.uint32)
    log_weights = np.log(sets.weights).astype(np.float32)
    order = np.argsort(-sets.lens, kind="stable")
    order = order[: np.count_nonzero(sets.lens)]
    begin = 0
    while begin < len(order):
        # texts of like length are the rows of a matrix, filled up with shingles of no weight
        width = int(sets.lens[order[begin]])
        part = order[begin : begin + max(1, CHUNK // width)]
        begin += len(part)
        column = np.arange(width)
        at = np.minimum(sets.starts[part, None] + column, len(sets.shingles) - 1)
        log_s = np.where(column < sets.lens[part, None], log_weights[at], np.float32(-np.inf))
        out[part] = _sampled(sets.shingles[at], log_s)
    return out


def _sampled(code: np.ndarray, log_s: np.ndarray) -> np.ndarray:
    """The samples of the texts whose shingles and logarithms of weights are the rows."""
    h, index = np.empty_like(code), np.empty(code.shape, np.intp)
    r, log_c, beta, t, log_a = (np.empty(code.shape, np.float32) for _ in range(5))
    row = np.arange(len(code))
    chosen, level = np.empty((len(code), SAMPLES), np.uint64), np.empty((len(code), SAMPLES), np.float32)
    for k in range(SAMPLES):
        np.multiply(code, SEEDS[2 * k], out=h)
        np.right_shift(h, np.uint64(29), out=index.view(np.uint64))
        h ^= index.view(np.uint64)
        h *= SEEDS[2 * k + 1]
        np.right_shift(h, np.uint64(48), out=index.view(np.uint64))
        GAMMA_R.take(index, out=r, mode="clip")
        h >>= np.uint64(16)
        np.bitwise_and(h, np.uint64(0xFFFF), out=index.view(np.uint64))
        np.multiply(index, np.float32(1 / 65536), out=beta, casting="same_kind", dtype=np.float32)
        h >>= np.uint64(16)
        np.bitwise_and(h, np.uint64(0xFFFF), out=index.view(np.uint64))
        LOG_C.take(index, out=log_c, mode="clip")
        np.divide(log_s, r, out=t)
        t += beta
        np.floor(t, out=t)
        np.subtract(t, beta, out=log_a)
        log_a += np.float32(1)
        log_a *= r
        np.subtract(log_c, log_a, out=log_a)
        least = log_a.argmin(1)
        chosen[:, k], level[:, k] = code[row, least], t[row, least]
    return mix(chosen + level.astype(np.int64).astype(np.uint64) * SEEDS[0]).astype(np.uint32)


# -- Spark side ------------------------------------------------------------


def document_frequencies(docs: DataFrame) -> Broadcast:
    """Broadcast of the Idf of all documents."""
    schema = pa.schema([("word", pa.int64()), ("df", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, dfs = [], []
        for batch in slices(batches):
            w = lexical_words_of(batch.column(0))
            pairs = np.sort(w.doc * np.int64(max(1, len(w.vocab))) + w.idx)
            pairs = pairs[np.diff(pairs, prepend=-1) > 0]
            words.append(hash_words(w.vocab))
            dfs.append(np.bincount(pairs % max(1, len(w.vocab)), minlength=len(w.vocab)))
            if sum(map(len, words)) > 1_000_000:
                yield _added_up(schema, words, dfs)
                words, dfs = [], []
        if words:
            yield _added_up(schema, words, dfs)

    n = docs.count()
    counts = docs.select("text").mapInArrow(count, "word long, df long").groupBy("word").agg(F.sum("df").alias("df"))
    table = counts.filter(F.col("df") * RARE >= n).toArrow()
    words = table["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    # a word of every document still counts a little, so no text is without weight
    values = np.log((n + 1) / table["df"].to_numpy().astype(np.float64))[order]
    return docs.sparkSession.sparkContext.broadcast(Idf(words[order], values, float(np.log(min(n, RARE) + 1))))


def _added_up(schema: pa.Schema, words: list[np.ndarray], dfs: list[np.ndarray]) -> pa.RecordBatch:
    distinct, where = np.unique(np.concatenate(words), return_inverse=True)
    return record_batch(schema, [distinct.view(np.int64), np.bincount(where, np.concatenate(dfs), minlength=len(distinct)).astype(np.int64)])


def signatures(docs: DataFrame, idf: Broadcast) -> DataFrame:
    """doc_id, node (digest of the words; null without words), sig and size (bytes of text) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.binary()), ("sig", pa.list_(pa.int32())), ("size", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=SIGNED_BYTES):
            sets = weighted_sets(batch.column(1), idf.value)
            sig = samples(sets).view(np.int32).ravel()
            sigs = pa.ListArray.from_arrays(np.arange(0, len(sig) + 1, SAMPLES, dtype=np.int32), sig)
            yield record_batch(schema, [batch.column(0), sets.content, sigs, pc.binary_length(batch.column(1))])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, node binary, sig array<int>, size int")


def buckets(sigs: DataFrame, scratch: Scratch) -> DataFrame:
    """(band, key, node, n, head) of the contents that share a bucket with others."""
    keys = F.array(*[F.xxhash64(F.lit(b), F.slice("sig", b * ROWS + 1, ROWS)) for b in range(BANDS)])
    members = sigs.select(F.posexplode(keys).alias("band", "key"), "node")
    stats = members.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("head")).filter("n > 1")
    return scratch.store(members.join(stats, "key"), "buckets")


def bucket_pairs(met: DataFrame) -> DataFrame:
    """Pairs (a < b) met first: all of small buckets, and of larger ones those
    with the head and inside groups drawn by hash (the rest: ``cells``)."""
    star = met.filter(F.col("n") > SMALL).select(F.col("head").alias("a"), F.col("node").alias("b"))
    part = F.when(F.col("n") > SMALL, F.pmod(F.xxhash64("key", "node"), F.ceil(F.col("n") / GROUP))).otherwise(F.lit(0))
    groups = met.select("key", part.alias("part"), "node")
    within = groups.withColumnRenamed("node", "a").join(groups.withColumnRenamed("node", "b"), ["key", "part"])
    return star.unionByName(within.select("a", "b")).filter("a < b").distinct()


def agreement(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with the number of samples on which both agree."""
    a = sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    b = sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
    same = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda s: s))
    return pairs.join(a, "a").join(b, "b").withColumn("same", same).drop("sig_a", "sig_b")


def candidate_pairs(met: DataFrame, sigs: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, same) of the pairs met first that are worth verifying."""
    return scratch.store(agreement(bucket_pairs(met), sigs).filter(F.col("same") >= LEAST_AGREEMENT), "candidates")


# -- the rest of the larger buckets ------------------------------------------

CELL = ["key", "t1", "t2"]


def cells(met: DataFrame, sigs: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame | None:
    """(key, t1, t2, nodes, roots, pairs): every pair of contents of a larger
    bucket that is worth verifying and not in one class by ``roots``, once, as
    packed positions in the nodes of a pair of tiles; None where all larger
    buckets are of one class."""
    large = met.filter(F.col("n") > SMALL).select("band", "key", "node").join(roots, "node", "left")
    large = large.withColumn("root", F.coalesce("root", "node"))
    mixed = large.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key")
    members = scratch.store(large.join(mixed, "key").join(sigs, "node").select("band", "key", "node", "root", "size", "sig"), "mixed")
    if members.isEmpty():
        return None

    def tiles(count: Column, size: Column) -> Column:
        return F.ceil(F.greatest(count / TILE, size / TILE_BYTES))

    # a class that fills half a tile has tiles of its own, the others share some
    of_root = members.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    of_root = of_root.withColumn("own", (F.col("n") * 2 >= TILE) | (F.col("bytes") * 2 >= TILE_BYTES))
    shared = of_root.filter("not own").groupBy("key").agg(tiles(F.sum("n"), F.sum("bytes")).alias("shared"))
    own_tile = F.xxhash64("root", F.pmod(F.xxhash64("node"), tiles(F.col("n"), F.col("bytes"))))
    tile = F.when(F.col("own"), own_tile).otherwise(F.pmod(F.xxhash64("root"), F.col("shared")))
    placed = members.join(of_root, ["key", "root"]).join(shared, "key", "left")
    placed = scratch.store(placed.select("key", tile.alias("tile"), "band", "node", "root", "own", "sig"), "placed")

    known = placed.groupBy("key", "tile").agg(F.min(F.when(F.col("own"), F.col("root"))).alias("whole"))
    one, two = (known.select("key", F.col("tile").alias(f"t{i}"), F.col("whole").alias(f"whole{i}")) for i in (1, 2))
    pairs = one.join(two, "key").filter("t1 <= t2 and coalesce(whole1 <> whole2, true)").select(*CELL)
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("t1").alias("tile")), F.struct(F.lit(1).alias("side"), F.col("t2").alias("tile")))
    met_in = pairs.select(*CELL, F.inline(sides)).filter("side = 0 or t1 <> t2").join(placed, ["key", "tile"])
    schema = pa.schema([*[(c, pa.int64()) for c in CELL], ("nodes", pa.list_(pa.binary())), ("roots", pa.list_(pa.binary())), ("pairs", pa.binary())])

    def compare(cell: pa.Table) -> pa.Table:
        sides = [cell.filter(pc.equal(cell["side"], i)) for i in (0, 1)]
        left, right = sides[0], sides[1] if sides[1].num_rows else sides[0]
        same_tile, band = left is right, cell["band"][0].as_py()
        left, right = left.combine_chunks(), right.combine_chunks()
        x, y = (pc.list_flatten(t["sig"]).to_numpy().reshape(-1, SAMPLES) for t in (left, right))
        out = []
        for start in range(0, len(x), 64):
            agree = np.zeros((min(64, len(x) - start), len(y)), np.uint8)
            for k in range(SAMPLES):
                agree += x[start : start + 64, k, None] == y[None, :, k]
            i, j = np.nonzero(agree >= LEAST_AGREEMENT)
            i += start
            if same_tile:
                i, j = i[i < j], j[i < j]
            # a pair of several common buckets is taken in the first of them
            bands = (x[i] == y[j]).reshape(-1, BANDS, ROWS).all(2)
            first = bands.argmax(1) == band
            out.append((i[first], j[first]))
        i, j = (np.concatenate([p[k] for p in out]) for k in (0, 1))
        nodes, roots = ([v for t in (left, right) for v in t[c].to_pylist()] for c in ("node", "root"))
        number = {r: n for n, r in enumerate(set(roots))}
        group = np.array([number[r] for r in roots])
        pairs = np.column_stack([i, j + len(x)])
        pairs = pairs[group[pairs[:, 0]] != group[pairs[:, 1]]]
        if not len(pairs):
            return schema.empty_table()
        used, at = np.unique(pairs, return_inverse=True)
        row = [*[cell[c][0].as_py() for c in CELL], [nodes[n] for n in used], [roots[n] for n in used], at.astype(np.int32).tobytes()]
        return pa.Table.from_batches([record_batch(schema, [[v] for v in row])])

    found = met_in.groupBy(*CELL).applyInArrow(compare, "key long, t1 long, t2 long, nodes array<binary>, roots array<binary>, pairs binary")
    return scratch.store(found, "rest")


def cell_links(rest: DataFrame, texts: DataFrame, idf: Broadcast, similarity: float) -> DataFrame:
    """(a, b): of the pairs of ``cells`` verified ones that connect all contents
    that the verified ones connect."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(cell: pa.Table, body: pa.Table) -> pa.Table:
        sets, top = {}, {}
        for whole in body.select(["node", "text"]).to_batches():
            for batch in slices(iter([whole]), max_bytes=SIGNED_BYTES):
                s = weighted_sets(batch.column(1), idf.value)
                for node, at, n in zip(batch.column(0).to_pylist(), s.starts.tolist(), s.lens.tolist(), strict=True):
                    sets[node] = s.shingles[at : at + n], s.weights[at : at + n]

        def root(x: bytes) -> bytes:
            while x in top:
                x = top[x]
            return x

        found = []
        for r in cell.to_pylist():
            nodes, roots = r["nodes"], r["roots"]
            for i, j in np.frombuffer(r["pairs"], np.int32).reshape(-1, 2).tolist():
                x, y = root(roots[i]), root(roots[j])
                if x != y and weighted_jaccard(sets[nodes[i]], sets[nodes[j]]) >= similarity:
                    top[max(x, y)] = min(x, y)
                    found.append((nodes[i], nodes[j]))
        return pa.Table.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], schema=schema)

    of = [f"of_{c}" for c in CELL]
    nodes = rest.select(*[F.col(c).alias(o) for c, o in zip(CELL, of, strict=True)], F.explode("nodes").alias("node")).distinct()
    bodies = nodes.join(texts, "node").select(*of, "node", "text")
    return rest.groupBy(*CELL).cogroup(bodies.groupBy(*of)).applyInArrow(run, "a binary, b binary")


def verified(pairs: DataFrame, texts: DataFrame, idf: Broadcast, similarity: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity is at least ``similarity``."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(iter([whole]), "text_a", SIGNED_BYTES):
                left, right = (weighted_sets(batch.column(k), idf.value) for k in (2, 3))

                def one(s: WeightedSets, i: int) -> tuple[np.ndarray, np.ndarray]:
                    at = slice(s.starts[i], s.starts[i] + s.lens[i])
                    return s.shingles[at], s.weights[at]

                keep = [weighted_jaccard(one(left, i), one(right, i)) >= similarity for i in range(batch.num_rows)]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_())).cast(schema)

    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has no more than ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def classes(docs: DataFrame, scratch: Scratch, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, node, class_id (the least id of its class) and head (whether its
    content is the one that stays of its class; null without words) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of())
    idf = document_frequencies(docs)
    rows = scratch.store(signatures(docs, idf), "signatures")
    full = rows.filter("node is not null")
    # one signature a content: those of its rows are all the same
    contents = full.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.min("sig").alias("sig"), F.max("size").alias("size"))
    sigs = scratch.store(contents, "contents")
    met = buckets(sigs.select("node", "sig"), scratch)
    pairs = candidate_pairs(met, sigs.select("node", "sig"), scratch)
    involved = F.explode(F.array("a", "b")).alias("node")
    texts = texts_of(docs, sigs, pairs.select(involved), scratch, "texts")

    best = pairs.groupBy("b").agg(F.max(F.struct("same", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    first = scratch.store(verified(best, texts, idf, similarity), "links-1")
    found = scratch.store(components(first, scratch, "components-1"), "classes-1")
    rest = pairs.select("a", "b").join(best, ["a", "b"], "left_anti")
    root_a, root_b = (found.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
    rest = rest.join(root_a, "a", "left").join(root_b, "b", "left")
    rest = rest.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
    second = scratch.store(verified(rest, texts, idf, similarity), "links-2")
    links = first.unionByName(second)
    roots = scratch.store(components(links, scratch, "components-2"), "classes-2")
    left = cells(met, sigs.select("node", "sig", "size"), roots, scratch)
    if left is not None and not left.isEmpty():
        third = scratch.store(cell_links(left, texts_of(docs, sigs, left.select(F.explode("nodes").alias("node")), scratch, "texts-2"), idf, similarity), "links-3")
        roots = scratch.store(components(links.unionByName(third), scratch, "components-3"), "classes-3")

    of_root = sigs.select("node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # the least id of each class, and of the contents with it the one that heads the class
    least = of_root.groupBy("root").agg(F.min(F.struct(F.col("least_id").isNull(), "least_id", F.col("node").alias("head"))).alias("least"))
    class_of = of_root.join(least, "root").select("node", F.col("least.least_id").alias("class_id"), (F.col("node") == F.col("least.head")).alias("head"))
    class_id = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    return rows.select("doc_id", "node").join(class_of, "node", "left").select("doc_id", "node", class_id, "head")


def texts_of(docs: DataFrame, sigs: DataFrame, nodes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, text) of the named contents, read again by the id of one of their rows."""
    ids = scratch.store(sigs.join(nodes.distinct(), "node").select("node", F.col("least_id").alias("doc_id")), f"{name}-ids")
    wanted = small_enough(ids.select(F.col("doc_id").alias("wanted")).distinct())
    picked = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    body = with_node(picked, "node").join(ids.select("node"), "node", "left_semi").dropDuplicates(["node"])
    return scratch.store(body.select("node", "text"), name)


def with_node(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with the digest of each text's words in a new column."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = lexical_words_of(batch.column(at))
            word = hash_words(w.vocab)[w.idx]
            digests = [xxhash.xxh3_128_digest(word[a : a + n].tobytes()) if n else None for a, n in zip(w.starts.tolist(), w.lens.tolist(), strict=True)]
            yield batch.append_column(column, pa.array(digests, pa.binary()))

    return docs.mapInArrow(run, docs.withColumn(column, F.lit(None).cast("binary")).schema)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and class_id (the least id among its near duplicates) of every row."""
    scratch = Scratch(docs.sparkSession)
    return scratch.finish(classes(docs, scratch, similarity).select("doc_id", "class_id"))


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class: that of the least id (of rows that
    share id and words any one), with all its columns."""
    scratch = Scratch(docs.sparkSession)
    table = scratch.store(classes(docs, scratch, similarity), "result")
    full = table.filter(F.col("node").isNotNull())
    stays = F.col("head") & F.col("doc_id").eqNullSafe(F.col("class_id"))
    node, gone_id, gone_node, one_id, one_node = fresh(docs, 5)
    gone = full.filter(~stays).select(F.col("doc_id").alias(gone_id), F.col("node").alias(gone_node)).distinct().checkpoint(eager=True)
    # rows that share id and content with the one that stays of their class: one of them stays
    shared = full.filter(stays).groupBy("doc_id", "node").count().filter("count > 1")
    shared = shared.select(F.col("doc_id").alias(one_id), F.col("node").alias(one_node)).checkpoint(eager=True)
    scratch.delete()
    marked = with_node(docs, node)
    id_of = F.col("doc_id").cast("long")
    kept = marked.join(small_enough(gone), id_of.eqNullSafe(F.col(gone_id)) & (F.col(node) == F.col(gone_node)), "left_anti")
    if not shared.isEmpty():
        joined = kept.join(small_enough(shared), id_of.eqNullSafe(F.col(one_id)) & (F.col(node) == F.col(one_node)), "left")
        one = joined.filter(F.col(one_node).isNotNull()).dropDuplicates([node])
        kept = joined.filter(F.col(one_node).isNull()).unionByName(one)
    return kept.select(*docs.columns)


def fresh(docs: DataFrame, n: int) -> list[str]:
    """Column names that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    return [c for c in (f"_dedup{i}" for i in range(n + len(taken))) if c not in taken][:n]
