"""Operator 8: SpotSigs document fingerprints.

A signature is an anchor (a common word of one of four languages) with the
chain of the next ``CHAIN`` content words after it; a text's fingerprint is
the set of its signatures, as 32-bit hashes in ascending order.  The start of
a text counts as an anchor, and in stretches without common words (lists,
tables) so do words picked by their hash, so every text with a word has a
signature.  Two fingerprints are compared by their Jaccard similarity, pruned
by their lengths: the shorter set's share of the longer one bounds it.

``near_pairs`` finds all similar fingerprints: equal ones are one from the
start; the others are partitioned by set length so that similar sets lie in
the same or the next partition; in it they meet on the rarest signatures of
each (as many as any similar set must share one of), and are verified.

``fingerprint_table`` also compares each text with an edited text, whose
second half is taken from the next document in descending order of id.

Scale: one shuffle of the texts, by ranges of ids whose bounds are quantiles
of the id column; a range's first document is sent along to the range before
it, so each task has what its last document needs.  A task streams its sorted
rows and holds a batch and one row.

Defined results: null and empty texts have the empty fingerprint; two empty
fingerprints are alike (1), an empty and a full one are not (0); rows of equal
id are ordered by their text, null ids come last; the only row of a table is
its own next; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import hash_words, lexical_words_of, mix, record_batch, slices, text_of

CHAIN = 2
#: A word with no anchor among so many words before it is one itself if its hash falls right.
STRETCH, EVERY = 8, 6
#: Text compared at once in a task: it is cut into words twice, with a dozen numbers a word.
COMPARED_BYTES = 3 << 20
# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was were which with you "
    "als auch auf aus bei das dass dem den der des die ein eine einen er es für hat ich im ist mit nicht sich sie sind und von war wie wir zu zum "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas pour qu que qui sa se ses son sur un une vous "
    "al como con del desde el ella ellos esta este fue han la las lo los más no nos o para pero por porque que se ser si sin su sus también una y ya"
)
ANCHOR_HASHES = np.unique(hash_words(pa.array(ANCHORS.split())))


def fingerprints(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct signatures of each text."""
    w = lexical_words_of(texts)
    n = len(w.idx)
    if not n:
        return [np.zeros(0, np.uint32)] * len(texts)
    vocab = hash_words(w.vocab)
    common = np.isin(vocab, ANCHOR_HASHES)[w.idx]
    word, doc, at = vocab[w.idx], w.doc, np.arange(n)
    first = w.starts[doc]
    # the last common word before each word, or the text's start
    last = np.maximum.accumulate(np.where(common, at, -1))
    before = np.concatenate([[-1], last[:-1]])
    since = at - np.where(before >= first, before, first - 1)
    stand_in = ~common & (since > STRETCH) & (mix(word) % np.uint64(EVERY) == 0)
    content = np.flatnonzero(~common)
    anchor = np.flatnonzero(common | stand_in)
    starts = w.starts[w.lens > 0]
    # chains: of anchors from the next word on, of a text's start from its first
    origin = np.concatenate([anchor + 1, starts])
    name = np.concatenate([word[anchor], np.zeros(len(starts), np.uint64)])
    owner = np.concatenate([doc[anchor], doc[starts]])
    end = (w.starts + w.lens)[owner]
    j = np.searchsorted(content, origin)
    code, links = mix(name + np.uint64(1)), np.zeros(len(origin), np.int64)
    for k in range(CHAIN):
        place = np.minimum(j + k, max(len(content) - 1, 0))
        inside = (j + k < len(content)) & (content[place] < end if len(content) else False)
        code = np.where(inside, mix(code * np.uint64(3) + word[content[place]]), code) if len(content) else code
        links += inside
    # an anchor at the end has no chain; a start always has one (maybe of common words only)
    start = np.arange(len(origin)) >= len(anchor)
    bare = start & (links == 0)
    code[bare] = [np.bitwise_xor.reduce(mix(word[a : a + m] + np.arange(m, dtype=np.uint64))) for a, m in zip(w.starts[owner[bare]], w.lens[owner[bare]], strict=True)]
    keep = (links > 0) | start
    pairs = np.unique(owner[keep].astype(np.uint64) << np.uint64(32) | code[keep] >> np.uint64(32))
    cuts = np.searchsorted(pairs >> np.uint64(32), np.arange(1, len(texts)).astype(np.uint64))
    return np.split((pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32), cuts)


def as_string(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two fingerprints; 0 without looking further where
    their lengths show that it is below ``least``."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    if min(len(a), len(b)) / longer < least:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    value = common / (len(a) + len(b) - common)
    return value if value >= least else 0.0


# -- Spark side ------------------------------------------------------------

LOWEST = -(1 << 63)


def neighbour_ranges(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, text, range, guest): every row in
    its range of ids, and a copy (guest) of each range's first rows in the
    range that precedes it in descending order."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    key = F.coalesce("doc_id", F.lit(LOWEST))
    ids = docs.select(key.alias("key"))
    cuts = ids.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 100 * n).alias("cuts")).first().cuts if n > 1 else []
    bounds = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(np.int64), "left"))

    # the first id of each range, in descending order; at most a row a range
    heads = sorted(ids.withColumn("range", range_of("key")).groupBy("range").agg(F.max("key").alias("head")).collect(), key=lambda r: -r.range)
    target = {heads[(i + 1) % len(heads)].head: r.range for i, r in enumerate(heads)}

    @F.pandas_udf("array<int>")
    def ranges_of(keys: pd.Series) -> pd.Series:
        own = np.searchsorted(bounds, keys.to_numpy(np.int64), "left").tolist()
        return pd.Series([[r, target[k]] if k in target else [r] for r, k in zip(own, keys.tolist(), strict=True)])

    placed = docs.withColumn("ranges", ranges_of(key))
    return placed.select("doc_id", "text", F.posexplode("ranges").alias("guest", "range"))


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next of every row."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string())]
        + [("near_edited", pa.float64()), ("near_next", pa.float64())]
    )
    ddl = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def compare(doc_ids: pa.Array, texts: list[str], following: list[str], prints: list[np.ndarray], after: list[np.ndarray]) -> pa.RecordBatch:
        edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, following, strict=True)]
        edits = fingerprints(pa.array(edited, pa.string()))
        return record_batch(
            schema,
            [
                doc_ids,
                [len(t) for t in texts],
                [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                [as_string(p) for p in prints],
                [as_string(p) for p in edits],
                [likeness(p, e) for p, e in zip(prints, edits, strict=True)],
                [likeness(p, q) for p, q in zip(prints, after, strict=True)],
            ],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # doc_id, text and fingerprint of the row that waits for its next
        for batch in slices(batches, max_bytes=COMPARED_BYTES):
            ranges, guests = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            # a range's rows, then its guests, of which the first counts
            use = np.ones(len(ranges), bool)
            again = (guests[1:] > 0) & (guests[:-1] > 0) & (ranges[1:] == ranges[:-1])
            use[1:] = ~again
            if guests[0] > 0 and held is None:
                use[0] = False
            batch = batch.filter(pa.array(use))
            if not batch.num_rows:
                continue
            doc_ids, texts = batch.column(0), batch.column(1)
            ranges, guests = ranges[use], guests[use]
            prints = fingerprints(texts)
            if held is not None:
                doc_ids = pa.concat_arrays([pa.array([held[0]], pa.int64()), doc_ids])
                texts = pa.concat_arrays([pa.array([held[1]], pa.string()), texts])
                guests, prints = np.concatenate([[0], guests]), [held[2], *prints]
            own = np.flatnonzero(guests[:-1] == 0)
            if len(own):
                now, after = pa.array(own), pa.array(own + 1)
                yield compare(doc_ids.take(now), texts.take(now).to_pylist(), texts.take(after).to_pylist(), [prints[i] for i in own], [prints[i + 1] for i in own])
            held = (doc_ids[-1].as_py(), texts[-1].as_py(), prints[-1]) if guests[-1] == 0 else None

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of())
    placed = neighbour_ranges(rows).select("doc_id", "text", "range", "guest")
    order = ["range", "guest", F.col("doc_id").desc_nulls_last(), "text"]
    return placed.repartition("range").sortWithinPartitions(*order).mapInArrow(run, ddl)


def near_pairs(table: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Pairs (a < b, similarity) of distinct non-empty fingerprints of
    ``table`` (fingerprint) that are at least ``similarity`` alike."""

    @F.pandas_udf("array<long>")
    def decode(strings: pd.Series) -> pd.Series:
        return strings.map(lambda s: np.frombuffer(base64.b64decode(s), "<u4").astype(np.int64))

    sets = table.select("fingerprint").filter("fingerprint <> ''").distinct().withColumn("sigs", decode("fingerprint"))
    sets = sets.withColumn("n", F.size("sigs"))
    # sets of similar length lie in the same or the next partition of lengths
    width = F.lit(float(np.log(1 / similarity)))
    sets = sets.withColumn("part", F.floor(F.log(F.col("n")) / width).cast("int"))
    each = sets.select("fingerprint", "n", "part", F.explode("sigs").alias("sig"))
    rarity = each.groupBy("sig").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = each.join(rarity, "sig").groupBy("fingerprint", "n", "part").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("by_df"))
    # signatures of one set alone come first in the prefix and match nothing
    lone = F.col("n") - F.size("by_df")
    prefix = F.col("n") - F.ceil(F.lit(similarity) * F.col("n")) + 1 - lone
    heads = ranked.filter(prefix > 0).select("fingerprint", "n", "part", F.explode(F.slice("by_df", F.lit(1), F.greatest(prefix, F.lit(1)).cast("int"))).alias("s"))
    heads = heads.select("fingerprint", "n", "part", F.col("s.sig").alias("sig"))
    left = heads.select(F.col("fingerprint").alias("a"), F.col("n").alias("n_a"), "part", "sig")
    right = heads.select(F.col("fingerprint").alias("b"), F.col("n").alias("n_b"), F.explode(F.array("part", F.col("part") - 1)).alias("part"), "sig")
    fits = (F.col("n_a") <= F.col("n_b")) & (F.col("n_a") >= similarity * F.col("n_b")) & (F.col("a") != F.col("b"))
    met = left.join(right, ["part", "sig"]).filter(fits & ((F.col("n_a") < F.col("n_b")) | (F.col("a") < F.col("b")))).select("a", "b").distinct()
    of_a, of_b = (sets.select(F.col("fingerprint").alias(c), F.col("sigs").alias(f"sigs_{c}")) for c in "ab")
    common = F.size(F.array_intersect("sigs_a", "sigs_b"))
    alike = met.join(of_a, "a").join(of_b, "b").withColumn("similarity", common / (F.size("sigs_a") + F.size("sigs_b") - common))
    return alike.filter(F.col("similarity") >= similarity).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")
