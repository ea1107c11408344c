"""Operator 7: repeated passages by prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words of one document; a word is removed if
a window over it also starts in a document with a smaller id.  Those windows
are the leaves below the deep internal nodes (depth ``WINDOW``) of the suffix
tree of all texts, cut at that depth.  The tree is never whole anywhere:

1. Every window is filed under the least hash of its ``PREFIX``-word runs (its
   *key*), so equal windows share a key and about 18 neighbouring windows have
   the same one.  Keys of one content alone cannot lead to a deep node with
   two leaves and are dropped before any suffix is shipped.
2. The suffixes from one stretch of windows with a key travel as one row of
   word hashes.  A key shared by up to ``GROUP`` contents is a group that fits
   in memory; its subtree is built breadth first, the nodes at depth 2d being
   the pairs of nodes at depth d, and branches with a single leaf are left as
   soon as they appear.
3. The suffixes of more common keys are split by a longer prefix, the whole
   window (128 bits of hash).  Each of those groups is one deep node, of which
   only the least document id is needed: a minimum that is combined before its
   shuffle, and a join whose hot keys can be split at run time.

Texts with equal words are one content from the start: all but the least id
of such a group lose all words (if they have a window), without any suffix.

Scale: two map passes over the texts, a shuffle of the keys (about one in 18
words), one of the texts for the second pass, and of the shared suffixes; the
texts of documents that lose words are read again by their ids.

Defined results: null, empty and short texts (under ``WINDOW`` words) keep all
words; the digest of no words is that of the empty string; rows of equal id
never remove each other's words; a null id counts as larger than all others;
one row a row of the input; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, hash_words, mix, ragged, record_batch, slices, text_of, words_of

WINDOW, PREFIX = 50, 16
GROUP = 2048
#: Word hashes of subtrees built at once.
TREE_WORDS = 1_000_000
#: Documents that lose words are told to all tasks up to so many ranges, and joined by a shuffle beyond.
BROADCAST_RANGES = 500_000
LARGEST = (1 << 63) - 1


# -- windows and keys ------------------------------------------------------


def run_hashes(word: np.ndarray, seed: int, *lengths: int) -> list[np.ndarray]:
    """Hashes of the runs of each length (a power of two) from each position."""
    factor = mix(np.array([seed], np.uint64))[0] | np.uint64(1)
    out, h, n = {}, word, 1
    while n <= max(lengths):
        if n in lengths:
            out[n] = h
        h = mix(h[: max(len(h) - n, 0)] * factor + h[n:]) if len(h) > n else h[:0]
        n *= 2
    return [out[n] for n in lengths]


def window_keys(word: np.ndarray) -> np.ndarray:
    """The key of the window from each position of a batch's joined words: the
    least hash of its PREFIX-word runs."""
    (low,) = run_hashes(word, 1, PREFIX)
    n, width = WINDOW - PREFIX + 1, 1
    while width * 2 <= n:
        low = np.minimum(low[: max(len(low) - width, 0)], low[width:])
        width *= 2
    rest = n - width
    return np.minimum(low[: max(len(low) - rest, 0)], low[rest:]) if rest else low


def window_hashes(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash, as two columns, of the window from each position."""
    out = []
    for seed in (2, 3):
        h32, h16, h2 = run_hashes(word, seed, 32, 16, 2)
        n = max(len(word) - WINDOW + 1, 0)
        out.append(mix(mix(h32[:n] * np.uint64(seed * 2 + 1) + h16[32 : 32 + n]) * np.uint64(seed * 4 + 3) + h2[48 : 48 + n]))
    return out[0].view(np.int64), out[1].view(np.int64)


def content_digests(word: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> list[bytes]:
    return [xxhash.xxh3_128_digest(word[a : a + n].tobytes()) for a, n in zip(starts.tolist(), lens.tolist(), strict=True)]


# -- subtrees --------------------------------------------------------------


def deep_nodes(word: np.ndarray, chunk: np.ndarray, group: np.ndarray, n_windows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves below the deep internal nodes of the subtrees of some groups.

    ``word`` joins the word hashes of all rows, ``chunk`` names the row of each
    of them, ``group`` the group of each row.  Returns the window positions
    that share their whole window with another one, and their nodes."""
    node = np.unique(word, return_inverse=True)[1].astype(np.int64)
    node = np.unique(group[chunk] << np.int64(32) | node, return_inverse=True)[1].astype(np.int64)
    n, depth = len(node), 1
    # positions that are still in a branch with two leaves and start a window
    at = ragged(starts, n_windows)
    levels = []
    while depth * 2 <= WINDOW:
        pair = node[: n - depth] << np.int64(32) | node[depth:]
        longer = np.full(n, -1, np.int64)
        longer[: n - depth] = np.unique(pair, return_inverse=True)[1]
        levels.append(node)
        node, depth = longer, depth * 2
        if len(at):
            leaves = np.bincount(node[at] + 1)
            at = at[leaves[node[at] + 1] > 1]
    if not len(at):
        return at, at
    last = node[at] << np.int64(32) | node[at + WINDOW - depth]
    _, which, leaves = np.unique(last, return_inverse=True, return_counts=True)
    deep = leaves[which] > 1
    return at[deep], which[deep]


def covered_windows(rows: list[tuple[int, int, bytes]]) -> list[tuple[int, int, int]]:
    """For rows (group, document id, word hashes), the ranges (row, first, end)
    of windows that also start in a document with a smaller id."""
    parts = [np.frombuffer(b, "<u8") for *_, b in rows]
    lens = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(lens) - lens
    chunk = np.repeat(np.arange(len(rows)), lens)
    group, ids = np.array([g for g, *_ in rows], np.int64), np.array([d for _, d, _ in rows], np.int64)
    at, node = deep_nodes(np.concatenate(parts), chunk, np.unique(group, return_inverse=True)[1], lens - WINDOW + 1, starts)
    if not len(at):
        return []
    least = np.full(int(node.max()) + 1, LARGEST)
    np.minimum.at(least, node, ids[chunk[at]])
    at = np.sort(at[ids[chunk[at]] > least[node]])
    if not len(at):
        return []
    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(chunk[at]) > 0)) + 1
    return [(int(chunk[r[0]]), int(r[0] - starts[chunk[r[0]]]), int(r[-1] - starts[chunk[r[0]]]) + 1) for r in np.split(at, cut)]


# -- Spark side ------------------------------------------------------------


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, content, n_words, sha256 and the distinct keys of
    every row of ``docs`` (doc_id, text, text_hash)."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("content", pa.binary()), ("n_words", pa.int64()), ("sha256", pa.string()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = words_of(batch.column(1))
            word = hash_words(w.vocab)[w.idx] if len(w.vocab) else np.zeros(0, np.uint64)
            key = window_keys(word)
            n_windows = np.maximum(w.lens - WINDOW + 1, 0)
            at, doc = ragged(w.starts, n_windows), np.repeat(np.arange(len(w.lens)), n_windows)
            own = key[at].view(np.int64) if len(at) else np.zeros(0, np.int64)
            first = np.ones(len(own), bool)
            first[1:] = (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])
            order = np.lexsort((own[first], doc[first]))
            own, doc = own[first][order], doc[first][order]
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])
            own, doc = own[new], doc[new]
            keys = pa.ListArray.from_arrays(np.searchsorted(doc, np.arange(len(w.lens) + 1)).astype(np.int32), own)
            joined = w.vocab.take(pa.array(w.idx)).to_pylist()
            digests = [hashlib.sha256(" ".join(joined[a : a + n]).encode()).hexdigest() for a, n in zip(w.starts.tolist(), w.lens.tolist(), strict=True)]
            yield record_batch(schema, [batch.column(0), batch.column(2), content_digests(word, w.starts, w.lens), w.lens, digests, keys])

    return docs.mapInArrow(run, "doc_id long, text_hash long, content binary, n_words long, sha256 string, keys array<long>")


SUFFIX_DDL = "key long, more long, whole boolean, id long, content binary, start long, words binary"
SUFFIX = pa.schema(
    [("key", pa.int64()), ("more", pa.int64()), ("whole", pa.bool_()), ("id", pa.int64()), ("content", pa.binary()), ("start", pa.int64()), ("words", pa.binary())]
)


def suffixes(wanted: DataFrame) -> DataFrame:
    """Suffix rows of ``wanted`` (id, text, content, keys, common): for keys of
    groups that fit in memory, stretches of windows with their word hashes;
    for the common ones, single windows with their hash (``whole``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = words_of(batch.column(1))
            word = hash_words(w.vocab)[w.idx] if len(w.vocab) else np.zeros(0, np.uint64)
            key = window_keys(word).view(np.int64)
            a128, b128 = window_hashes(word)
            plain = word.astype("<u8")
            digests = content_digests(word, w.starts, w.lens)
            ids, contents = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, (start, n) in enumerate(zip(w.starts.tolist(), w.lens.tolist(), strict=True)):
                if digests[i] != contents[i] or n < WINDOW:
                    continue  # another row of the same id
                own = key[start : start + n - WINDOW + 1]
                shared = np.sort(np.array(batch.column(3)[i].as_py(), np.int64))
                common = np.sort(np.array(batch.column(4)[i].as_py(), np.int64))
                cut = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
                head = own[cut[:-1]]
                light = np.flatnonzero(np.isin(head, shared))
                rows = [(int(head[k]), 0, False, ids[i], contents[i], int(cut[k]), plain[start + cut[k] : start + cut[k + 1] + WINDOW - 1].tobytes()) for k in light]
                heavy = np.flatnonzero(np.isin(own, common)).tolist()
                rows += [(int(a128[start + k]), int(b128[start + k]), True, ids[i], contents[i], k, None) for k in heavy]
                if rows:
                    yield record_batch(SUFFIX, list(map(list, zip(*rows, strict=True))))

    return wanted.select("id", "text", "content", "keys", "common").mapInArrow(run, SUFFIX_DDL)


RANGES_DDL = "id long, content binary, start long, end long"


def subtree_ranges(rows: DataFrame) -> DataFrame:
    """Covered window ranges of the suffix rows of groups that fit in memory."""
    schema = pa.schema([("id", pa.int64()), ("content", pa.binary()), ("start", pa.int64()), ("end", pa.int64())])

    def ranges(held: list[tuple]) -> pa.RecordBatch:
        found = covered_windows([(key, doc, words) for key, doc, _, _, words in held])
        return record_batch(schema, [[held[r][1] for r, *_ in found], [held[r][2] for r, *_ in found], [held[r][3] + a for r, a, _ in found], [held[r][3] + b for r, _, b in found]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0  # rows of whole groups, and of one that may go on
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= TREE_WORDS * 8 and row[0] != held[-1][0]:
                    yield ranges(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield ranges(held)

    return rows.select("key", "id", "content", "start", "words").repartition("key").sortWithinPartitions("key").mapInArrow(run, RANGES_DDL)


def removed(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """id, content, n_removed and sha256 of the kept words, of the documents
    (id, text_hash, text) with covered windows ``ranges`` (id, text_hash,
    content, ranges)."""
    schema = pa.schema([("id", pa.int64()), ("content", pa.binary()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = words_of(batch.column(1))
            word = hash_words(w.vocab)[w.idx] if len(w.vocab) else np.zeros(0, np.uint64)
            digests, out = content_digests(word, w.starts, w.lens), []
            joined = w.vocab.take(pa.array(w.idx)).to_pylist()
            for i, (a, n) in enumerate(zip(w.starts.tolist(), w.lens.tolist(), strict=True)):
                content = batch.column(2)[i].as_py()
                if digests[i] != content:
                    continue  # another row of the same id
                change = np.zeros(n + 1, np.int64)
                for r in batch.column(3)[i].as_py():
                    change[r["start"]] += 1
                    change[min(r["end"] - 1 + WINDOW, n)] -= 1
                gone = np.cumsum(change[:n]) > 0
                kept = " ".join([joined[a + k] for k in np.flatnonzero(~gone)])
                out.append((batch.column(0)[i].as_py(), content, int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
            if out:
                yield record_batch(schema, list(map(list, zip(*out, strict=True))))

    small = ranges.agg(F.coalesce(F.sum(F.size("ranges")), F.lit(0))).first()[0] <= BROADCAST_RANGES
    told = docs.join(F.broadcast(ranges) if small else ranges, ["id", "text_hash"])
    done = told.select("id", "text", "content", "ranges").mapInArrow(run, "id long, content binary, n_removed long, kept_sha256 string")
    return done.dropDuplicates(["id", "content"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    scratch = Scratch(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(LARGEST)).alias("id"), text_of())
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    rows = scratch.store(scan(texts.select("doc_id", "text", "text_hash")), "rows").withColumn("id", F.coalesce("doc_id", F.lit(LARGEST)))

    # one content a text; its least id stands for all its copies.  A text is met
    # again by id and hash, since an id (or none) can belong to many texts
    of_content = rows.groupBy("content").agg(F.min(F.struct("id", "text_hash")).alias("row"), F.first("keys").alias("keys"))
    contents = scratch.store(of_content.select("content", "row.id", "row.text_hash", "keys"), "contents")
    each = contents.select("id", "text_hash", "content", F.explode("keys").alias("key"))
    groups = each.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    groups = groups.filter("low < high").select("key", (F.col("n") > GROUP).alias("common"))
    met = each.join(groups, "key").groupBy("id", "text_hash", "content")
    pick = lambda flag: F.collect_list(F.when(F.col("common") == flag, F.col("key")))  # noqa: E731  no more than a text's keys
    wanted = met.agg(pick(False).alias("keys"), pick(True).alias("common"))

    leaves = scratch.store(suffixes(texts.select("id", "text_hash", "text").join(wanted, ["id", "text_hash"])), "suffixes")
    single = leaves.filter("whole")
    least = single.groupBy("key", "more").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").select("key", "more", "low")
    heavy = single.join(least, ["key", "more"]).filter("id > low").select("id", "content", "start", (F.col("start") + 1).alias("end"))
    covered = subtree_ranges(leaves.filter("not whole")).unionByName(heavy)
    of_text = covered.groupBy("id", "content").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    ranges = scratch.store(of_text.join(contents.select("id", "content", "text_hash"), ["id", "content"]), "ranges")

    changed = scratch.store(removed(texts.select("id", "text_hash", "text"), ranges), "changed")
    of_copy = contents.select("content", F.col("id").alias("first_id"))
    copy = (F.col("id") > F.col("first_id")) & (F.col("n_words") >= WINDOW)
    empty = hashlib.sha256(b"").hexdigest()
    out = rows.drop("keys", "text_hash").join(of_copy, "content").join(changed, ["id", "content"], "left")
    return scratch.finish(
        out.select(
            "doc_id",
            "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        )
    )
