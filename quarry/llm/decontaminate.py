"""Operator 4: benchmark decontamination by BM25 retrieval.

The benchmark items are indexed, the training passages are the queries.  Each
item's BM25 weights are divided by its own best score, so an item scores 1 for
a passage that holds all its words, and one threshold fits all items.  Every
passage of every text is a query, and every item above the threshold is
retrieved, by block-max WAND over whole batches at once:

1. items lie in blocks of similar length, and each word has its largest weight
   a block; the words in most blocks (they bound little and are in nearly
   every passage) are set aside, and what they can add to a block at most is
   known beforehand;
2. for all passages of a batch the block maxima of the other words are summed;
   a passage and a block whose sum and set-aside bound stay below the
   threshold are skipped, which loses nothing, since the sums bound the score
   from above;
3. the remaining blocks are scored exactly, over the passage's distinct words;
4. retrieved pairs are verified: the share of the item's five-word shingles in
   the passage, for its question part and its answer part.

A passage is 2 * s words every s words, where s is the longest item's length
in the index at hand, so every occurrence of an item lies whole in a passage.
Indexes are built by length class (powers of two), so short items meet short
passages.

Scale: map-only over the documents.  The benchmark is cut into slices of about
``SLICE_BYTES`` of text by a hash of the item; one slice's indexes are
broadcast at a time (word statistics come from all items), each slice is a
pass over the documents, and the slices' results are joined.

Defined results: null and empty texts match nothing, items without words are
never found; a repeated item counts once; every row of the documents gives its
own matches, also under a repeated id; without items or documents there are no
rows; columns other than the named ones are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import hash_words, lexical_words_of, ragged, record_batch, slices

K1, B = 1.2, 0.3
THRESHOLD = 0.5
#: Overlap that question and answer both need, or the whole item on its own.
PART_OVERLAP, WHOLE_OVERLAP = 0.6, 0.8
SHINGLE = 5
BLOCK = 8
#: Words in more than one of so many blocks are set aside in the bounds.
ASIDE = 3
#: And add no more than this to any block, so that a threshold above it needs other words.
MOST_ASIDE = 0.3
#: Postings summed at once.
PIECE = 4_000_000
SLICE_BYTES = 8 << 20


@dataclass
class Item:
    item_id: int | None
    words: np.ndarray  # hashes in order
    question: int  # number of words of the question part


@dataclass
class Index:
    """Block-max index of items of one length class."""

    items: list[Item]
    span: int  # s: words of the longest item
    terms: np.ndarray  # sorted word hashes
    first: np.ndarray  # of each term: its postings by block, as a range
    blocks: np.ndarray
    maxima: np.ndarray
    rest: np.ndarray  # of each block: the most that set-aside words can add
    block_terms: list[np.ndarray]  # of each block: its sorted term numbers
    block_weights: list[np.ndarray]  # and their weights, a column an item


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: up to the first question mark, else all but the
    last sentence; a single sentence is all question."""
    cut = text.find("?") + 1
    if not cut:
        ends = [m.end() for m in re.finditer(r"[.!\n]+(?=\s*\S)", text)]
        cut = ends[-1] if ends else len(text)
    return text[:cut], text[cut:]


def items_of(rows: list[tuple[int | None, str]]) -> list[Item]:
    out = []
    for item_id, text in rows:
        parts = lexical_words_of(pa.array(split_item(text)))
        words = hash_words(parts.vocab)[parts.idx] if len(parts.vocab) else np.zeros(0, np.uint64)
        if len(words):
            out.append(Item(item_id, words, int(parts.lens[0])))
    return out


def build(items: list[Item], df: dict[int, int], n_items: int, mean_words: float) -> list[Index]:
    """One index a length class (powers of two), from word statistics of all items."""
    classes: dict[int, list[Item]] = {}
    for item in items:
        classes.setdefault((len(item.words) - 1).bit_length(), []).append(item)
    return [_build(sorted(group, key=lambda i: len(i.words)), df, n_items, mean_words) for _, group in sorted(classes.items())]


def _build(items: list[Item], df: dict[int, int], n_items: int, mean_words: float) -> Index:
    weights = []
    for item in items:
        own = {}
        for word, tf in Counter(item.words.tolist()).items():
            idf = math.log(1 + (n_items - df[word] + 0.5) / (df[word] + 0.5))
            own[word] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(item.words) / mean_words))
        total = sum(own.values())
        weights.append({w: x / total for w, x in own.items()})
    terms = np.array(sorted({w for own in weights for w in own}), np.uint64)
    number = {w: i for i, w in enumerate(terms.tolist())}
    n_blocks = -(-len(items) // BLOCK)
    matrices: list[dict[int, np.ndarray]] = [{} for _ in range(n_blocks)]
    for i, own in enumerate(weights):
        for word, x in own.items():
            matrices[i // BLOCK].setdefault(number[word], np.zeros(BLOCK))[i % BLOCK] = x
    spread = Counter(t for m in matrices for t in m)
    aside, rest = set(), np.zeros((n_blocks, BLOCK))
    for t, n in sorted(spread.items(), key=lambda x: (-x[1], x[0])):
        more = np.array([m.get(t, np.zeros(BLOCK)) for m in matrices]) if n > max(1, n_blocks // ASIDE) else None
        if more is None or (rest + more).max() > MOST_ASIDE:
            break
        aside.add(t)
        rest += more
    postings = sorted((t, b, float(x.max())) for b, m in enumerate(matrices) for t, x in m.items() if t not in aside)
    first = np.searchsorted([t for t, *_ in postings], np.arange(len(terms) + 1))
    block_terms = [np.array(sorted(m), np.int64) for m in matrices]
    return Index(
        items,
        max(len(i.words) for i in items),
        terms,
        first,
        np.array([b for _, b, _ in postings], np.int64),
        np.array([x for *_, x in postings]),
        rest.max(axis=1),
        block_terms,
        [np.array([m[t] for t in own]) for m, own in zip(matrices, block_terms, strict=True)],
    )


def retrieve(index: Index, term: np.ndarray, starts: np.ndarray, lens: np.ndarray, threshold: float) -> Iterator[tuple[int, int, int, int, float]]:
    """(text, first word, end word, item number, score) of all passages and
    items at or above ``threshold``; ``term`` holds the term number of every
    word of the batch, or -1."""
    if threshold <= MOST_ASIDE:
        raise ValueError(f"the threshold must be above {MOST_ASIDE}")
    s = index.span
    doc = np.repeat(np.arange(len(lens)), lens)
    has_postings = np.diff(index.first) > 0
    at = np.flatnonzero((term >= 0) & has_postings[term])
    local = (at - starts[doc[at]]) // s
    # passage j of a text covers words [j * s, j * s + 2 * s)
    slots = lens // s + 1
    base = np.cumsum(slots) - slots
    slot, before, word = base[doc[at]] + local, local > 0, term[at].astype(np.int64)
    n_terms, n_blocks = len(index.terms), len(index.rest)
    pairs = np.sort(np.concatenate([slot * n_terms + word, (slot[before] - 1) * n_terms + word[before]]))
    pairs = pairs[np.diff(pairs, prepend=-1) > 0]  # each word once a passage
    slot, word = np.divmod(pairs, n_terms)
    n_post = np.diff(index.first)[word]
    # sums over pieces of whole passages, each of about PIECE postings
    piece = np.cumsum(n_post) // PIECE + slot * n_blocks // PIECE
    piece = piece[np.searchsorted(slot, slot)]  # a passage goes where its first word goes
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), len(slot)]
    found = [np.zeros(0, np.int64)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        posting = ragged(index.first[word[a:b]], n_post[a:b])
        if a < b:
            cell = (np.repeat(slot[a:b], n_post[a:b]) - slot[a]) * n_blocks + index.blocks[posting]
            bound = np.bincount(cell, index.maxima[posting], minlength=int(slot[b - 1] - slot[a] + 1) * n_blocks)
            found.append(np.flatnonzero(bound.reshape(-1, n_blocks) + index.rest >= threshold - 1e-9) + slot[a] * n_blocks)
    keys = np.concatenate(found)  # other blocks have their set-aside words at most, below any threshold
    owner = np.searchsorted(base, keys // n_blocks, "right") - 1
    last, present = -1, None
    for key, d in zip(keys.tolist(), owner.tolist(), strict=True):
        slot, block = divmod(key, n_blocks)
        a = int(starts[d] + (slot - base[d]) * s)
        b = int(min(a + 2 * s, starts[d] + lens[d]))
        if slot != last:
            last, present = slot, np.unique(term[a:b])
        own = index.block_terms[block]
        place = np.minimum(np.searchsorted(present, own), max(len(present) - 1, 0))
        score = (present[place] == own) @ index.block_weights[block] if len(present) else np.zeros(BLOCK)
        for i in np.flatnonzero(score >= threshold - 1e-9).tolist():
            if block * BLOCK + i < len(index.items):
                yield d, a, b, block * BLOCK + i, float(score[i])


def shingles(words: np.ndarray) -> set[bytes]:
    """Runs of five words, or all words if they are fewer."""
    n = min(SHINGLE, len(words))
    return {words[i : i + n].tobytes() for i in range(len(words) - n + 1)} if n else set()


def overlap(part: np.ndarray, passage: np.ndarray) -> float:
    """Share of a part's shingles that the passage holds; 1 for an empty part."""
    wanted = shingles(part)
    n = min(SHINGLE, len(part))
    have = {passage[i : i + n].tobytes() for i in range(len(passage) - n + 1)} if n else set()
    return len(wanted & have) / len(wanted) if wanted else 1.0


def matches(texts: pa.Array, indexes: list[Index], threshold: float = THRESHOLD) -> dict[tuple[int, int | None], tuple[float, float, float]]:
    """(text number, item id) -> (score, question overlap, answer overlap) of verified pairs."""
    w = lexical_words_of(texts)
    found: dict[tuple[int, int | None], tuple[float, float, float]] = {}
    if not len(w.idx):
        return found
    vocab = hash_words(w.vocab)
    for index in indexes:
        number = np.minimum(np.searchsorted(index.terms, vocab), len(index.terms) - 1)
        term = np.where(index.terms[number] == vocab, number, -1)[w.idx]
        for d, a, b, i, score in retrieve(index, term, w.starts, w.lens, threshold):
            item = index.items[i]
            passage = vocab[w.idx[a:b]]
            question, answer = overlap(item.words[: item.question], passage), overlap(item.words[item.question :], passage)
            if min(question, answer) >= PART_OVERLAP or overlap(item.words, passage) >= WHOLE_OVERLAP:
                key = (d, item.item_id)
                found[key] = max(found.get(key, (0.0, 0.0, 0.0)), (score, question, answer))
    return found


# -- Spark side ------------------------------------------------------------


def index_slices(benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> Iterator[list[Index]]:
    """The indexes of one slice of the items after another."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.length("text") > 0).distinct()
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if not size.n:
        return

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = lexical_words_of(batch.column(1))
            if len(w.idx):
                pairs, tf = np.unique(w.doc * len(w.vocab) + w.idx, return_counts=True)
                yield record_batch(schema, [hash_words(w.vocab)[pairs % len(w.vocab)].view(np.int64), tf])

    schema = pa.schema([("word", pa.int64()), ("tf", pa.int64())])
    n_slices = -(-size.bytes // slice_bytes)
    counted = items.mapInArrow(words, "word long, tf long")
    stats = counted.groupBy("word").agg(F.count("*").alias("df"))
    mean_words = (counted.agg(F.sum("tf")).first()[0] or 0) / size.n
    for k in range(n_slices):
        own = items.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(n_slices)) == k)
        rows = own.toArrow().to_pydict()  # about slice_bytes of text
        got = items_of(sorted(zip(rows["item_id"], rows["text"], strict=True), key=lambda r: (r[0] is None, r)))
        if not got:
            continue
        # word statistics of all items, for this slice's words only
        mine = stats.join(own.mapInArrow(words, "word long, tf long").select("word").distinct(), "word")
        table = mine.select("word", "df").toArrow()
        df = dict(zip(table["word"].to_numpy().view(np.uint64).tolist(), table["df"].to_pylist(), strict=True))
        yield build(got, df, size.n, max(1.0, mean_words))


def find_matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every row of
    ``docs`` and every item that is verified to stand in it."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])
    ddl = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for indexes in index_slices(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(indexes)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = sorted(matches(batch.column(1), shared.value, threshold).items(), key=lambda x: (x[0][0], x[0][1] is None, x[0][1] or 0))
                doc_ids = batch.column(0).take(pa.array([d for (d, _), _ in found], pa.int64()))
                yield record_batch(schema, [doc_ids, [i for (_, i), _ in found], *([x[k] for _, x in found] for k in range(3))])

        part = rows.mapInArrow(find, ddl)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], ddl)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    at = docs.columns.index("text")
    for indexes in index_slices(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(indexes)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                clean = np.ones(batch.num_rows, bool)
                clean[[d for d, _ in matches(batch.column(at), shared.value, threshold)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
