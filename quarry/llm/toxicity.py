"""Operator 5: counterfactual-regularised toxicity classifier.

A logistic model over the distinct lower-case words of a text.  For every
labelled text that names an identity group a counterfactual is made by
swapping each identity term for the next one of its list, and the squared
change of the score (its logit) between the two is added to the loss, so that
a neutral mention of a group cannot carry weight of its own.

Fit: at most ``sample`` labelled rows (the lowest hashes of their ids, of the
rows that may be learned from) reach the driver as hashed features, 8 bytes a
text and distinct word, held as two 32-bit numbers while they are fitted.  A
proximal gradient fit with a penalty in proportion to each word's sampling
noise picks the words, a second fit on those alone sets their weights.

Scale: the sample's ids (``sample`` rows at most, a documented bound) and the
picked words (no more than the sample's words) are broadcast; scoring is one
map-only pass in Arrow batches.

Defined results: null and empty texts get the score of a text without known
words; repeated labels of an id count once, as toxic if any is; rows with a
null label are not learned from; without labelled rows of both kinds every
score is the share of toxic ones (0.5 if there are none); an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import hash_words, lexical_words_of, record_batch, remainder, slices, text_of, training_row

SAMPLE = 12_000
THRESHOLD = 0.7
MODULUS, LEFT_OUT = 3, 1
#: Weight of the squared logit change of a counterfactual pair.
COUNTERFACTUAL = 10.0
#: Words in fewer sampled texts are not learned.
LEAST_TEXTS = 3
NOISE_SHARE = 3.5
#: Pairs of text and word that the fit takes at once.
BLOCK = 1 << 17

# Identity terms; each is swapped for the next of its list.
IDENTITY = [
    ["women", "men"],
    ["woman", "man"],
    ["girls", "boys"],
    ["she", "he"],
    ["her", "his"],
    ["gay", "straight", "lesbian", "bisexual"],
    ["trans", "cis"],
    ["black", "white", "asian", "latino"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["immigrants", "natives", "refugees"],
    ["american", "mexican", "chinese", "indian", "german", "french", "spanish", "african"],
    ["old", "young"],
    ["blind", "deaf", "disabled"],
    ["frauen", "männer"],
    ["femmes", "hommes"],
    ["mujeres", "hombres"],
]
SWAP = {w: group[(i + 1) % len(group)] for group in IDENTITY for i, w in enumerate(group)}
SWAP_HASH = {np.uint64(xxhash.xxh64_intdigest(a)): np.uint64(xxhash.xxh64_intdigest(b)) for a, b in SWAP.items()}


@dataclass
class Model:
    words: np.ndarray  # sorted hashes of the words that carry weight
    weights: np.ndarray
    bias: float


def _distinct(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, word hash) of every distinct word of each text, in order."""
    w = lexical_words_of(texts)
    pairs = np.unique(w.doc * np.int64(max(1, len(w.vocab))) + w.idx)
    doc, word = np.divmod(pairs, max(1, len(w.vocab)))
    return doc, hash_words(w.vocab)[word]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, left_out: int, sample: int) -> DataFrame:
    """doc_id, text, y of at most ``sample`` labelled rows that may be learned from."""
    rows = labels.filter(F.col(label).isNotNull() & training_row(F.col("doc_id"), modulus, left_out))
    known = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of())
    return texts.join(F.broadcast(chosen), "doc_id")  # bounded by ``sample``


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc, word = _distinct(batch.column(1))
            cuts = np.searchsorted(doc, np.arange(1, batch.num_rows))
            yield record_batch(schema, [batch.column(0), batch.column(2), [a.astype("<u8").tobytes() for a in np.split(word, cuts)]])

    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("words", pa.binary())])
    rows = labelled_sample(docs, labels, "toxic", MODULUS, LEFT_OUT, sample).mapInArrow(features, "doc_id long, y int, words binary")
    table = rows.groupBy("doc_id").agg(F.min(F.struct("y", "words")).alias("r")).select("doc_id", "r.*").toArrow().sort_by("doc_id")
    y, words = table["y"].to_numpy(), table["words"]
    lens = pc.binary_length(words).to_numpy() // 8
    parts = [_hashes(chunk) for chunk in words.chunks]
    hashes = parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, "<u8"), *parts])
    y = y.copy()
    del table, words, parts
    learned, pairs = _learned(hashes, lens)
    del hashes
    pa.default_memory_pool().release_unused()
    return _train(y, learned, pairs, COUNTERFACTUAL)


def _hashes(chunk: pa.BinaryArray) -> np.ndarray:
    """The word hashes of the texts of a chunk, joined, in the chunk's own memory."""
    offsets = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
    if not len(chunk) or offsets[0] == offsets[-1]:
        return np.zeros(0, "<u8")
    return np.frombuffer(chunk.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])), "<u8")


@dataclass
class Pairs:
    """Which texts hold which words, as 32-bit numbers in order of both, so that
    sums over the words of a text and over the texts of a word take them a
    block at a time: two numbers a pair are all that is held.  The order of a sum is
    that of one pass over all pairs."""

    word: np.ndarray  # of each pair, in order of texts
    text_at: np.ndarray  # where each text's pairs begin, and the end of the last
    text: np.ndarray  # of each pair, in order of words
    word_at: np.ndarray

    @classmethod
    def of(cls, word: np.ndarray, lens: np.ndarray, size: int) -> Pairs:
        text_at = _bounds(lens)
        word_at = _bounds(_counts(word, size))
        text, begin = np.empty(len(word), np.int32), word_at[:-1].copy()
        for a, b in _blocks(text_at):
            at = slice(text_at[a], text_at[b])
            order = np.argsort(word[at], kind="stable")
            sorted_words = word[at][order]
            place = begin[sorted_words] + np.arange(len(order)) - np.searchsorted(sorted_words, sorted_words)
            text[place] = np.repeat(np.arange(a, b, dtype=np.int32), lens[a:b])[order]
            begin += np.bincount(sorted_words, minlength=size)
        return cls(word, text_at, text, word_at)

    def by_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of the words' ``values`` over each text."""
        return _sums(self.text_at, self.word, values)

    def by_word(self, values: np.ndarray) -> np.ndarray:
        """Sum of the texts' ``values`` over each word."""
        return _sums(self.word_at, self.text, values)

    def text_of(self, pairs: np.ndarray) -> np.ndarray:
        """The texts of ``pairs`` (positions in order of texts)."""
        return np.searchsorted(self.text_at, pairs, side="right") - 1

    def only(self, words: np.ndarray, size: int) -> Pairs:
        """The pairs of the words that have a number (0 to ``size`` - 1; others: -1) in ``words``."""
        keep = np.empty(len(self.word), bool)
        for a in range(0, len(keep), BLOCK):
            keep[a : a + BLOCK] = words[self.word[a : a + BLOCK]] >= 0
        lens = np.array([np.count_nonzero(keep[a:b]) for a, b in pairwise(self.text_at)], np.int64)
        return Pairs.of(words.astype(np.int32)[self.word[keep]], lens, size)


def _bounds(lens: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)


def _counts(word: np.ndarray, size: int) -> np.ndarray:
    return sum((np.bincount(word[a : a + BLOCK], minlength=size) for a in range(0, len(word), BLOCK)), np.zeros(size, np.int64))


def _blocks(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts or words of about ``BLOCK`` pairs (one text or word at least)."""
    a = 0
    while a < len(bounds) - 1:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + BLOCK, side="right")) - 1)
        yield a, b
        a = b


def _sums(bounds: np.ndarray, items: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1)
    for a, b in _blocks(bounds):
        where = np.repeat(np.arange(b - a), np.diff(bounds[a : b + 1]))
        out[a:b] = np.bincount(where, values[items[bounds[a] : bounds[b]]], minlength=b - a)
    return out


def _learned(hashes: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, Pairs]:
    """The words of ``LEAST_TEXTS`` or more texts (sorted hashes), and who holds them."""
    ordered = np.sort(hashes)
    first = np.flatnonzero(np.concatenate([[True] * (len(ordered) > 0), ordered[1:] != ordered[:-1]]))
    words = ordered[first][np.diff(np.append(first, len(ordered))) >= LEAST_TEXTS]
    del ordered, first
    word, bounds = np.full(len(hashes), -1, np.int32), _bounds(lens)
    for a in range(0, len(hashes) if len(words) else 0, BLOCK):
        block = hashes[a : a + BLOCK]
        at = np.minimum(np.searchsorted(words, block), len(words) - 1)
        word[a : a + BLOCK] = np.where(words[at] == block, at, -1)
    lens = np.array([np.count_nonzero(word[a:b] >= 0) for a, b in pairwise(bounds)], np.int64)
    return words, Pairs.of(word[word >= 0], lens, len(words))


def train(y: np.ndarray, texts: list[np.ndarray], counterfactual: float = COUNTERFACTUAL) -> Model:
    """Fit the model to labels and the distinct word hashes of each text."""
    words, pairs = _learned(np.concatenate([np.zeros(0, np.uint64), *texts]), np.array([len(t) for t in texts], np.int64))
    return _train(y, words, pairs, counterfactual)


def _train(y: np.ndarray, words: np.ndarray, pairs: Pairs, counterfactual: float) -> Model:
    n = len(y)
    share = float(y.mean()) if n else 0.5
    if not n or not 0 < share < 1:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    # a counterfactual pair's logit changes by the weights it gains minus those it loses
    index = {w: i for i, w in enumerate(words)}
    swap = np.full(len(words), -2)  # -1: for a word that is not learned
    for a, b in SWAP_HASH.items():
        if a in index:
            swap[index[a]] = index.get(b, -1)
    at = np.concatenate([np.zeros(0, np.int64), *(a + np.flatnonzero(swap[pairs.word[a : a + BLOCK]] != -2) for a in range(0, len(pairs.word), BLOCK))])
    swaps = pairs.text_of(at), pairs.word[at].astype(np.int64), swap[pairs.word[at]]
    df = np.diff(pairs.word_at)
    noise = NOISE_SHARE * np.sqrt(df * share * (1 - share)) / n
    w, _ = _descend(y, pairs, swaps, counterfactual, noise, 0.0, share)
    kept = np.flatnonzero(w)
    if not len(kept):
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    back = np.full(len(words), -1)
    back[kept] = np.arange(len(kept))
    has = back[swaps[1]] >= 0 if len(swaps[1]) else np.zeros(0, bool)
    rest = swaps[0][has], back[swaps[1][has]], np.where(swaps[2][has] >= 0, back[swaps[2][has]], -1)
    w, bias = _descend(y, pairs.only(back, len(kept)), rest, counterfactual, 0.0, 0.1 / n, share)
    return Model(words[kept], w, bias)


def _descend(y, pairs: Pairs, swaps, strength, l1, l2, share, steps: int = 300) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on the mean log-loss, the counterfactual
    penalty and the L1 (a value a word) and L2 penalties; each word's column is
    scaled by the root of its frequency, so one step size suits all."""
    n, size = len(y), len(pairs.word_at) - 1
    df = np.diff(pairs.word_at)
    scale = 1 / np.sqrt(np.maximum(df, 1) / n)
    swap_doc, lost, gained = swaps
    pair, who = np.unique(swap_doc, return_inverse=True) if len(swap_doc) else (swap_doc, swap_doc)
    has = gained >= 0

    def change(w):
        z = np.bincount(who, -w[lost], minlength=len(pair))
        return z + np.bincount(who[has], w[gained[has]], minlength=len(pair))

    def gradient(v, b):
        w = v * scale
        p = 1 / (1 + np.exp(-np.clip(pairs.by_text(w) + b, -30, 30)))
        r = (p - y) / n
        g = pairs.by_word(r) + l2 * w
        if len(pair):
            d = 2 * strength * change(w)[who] / n
            g += np.bincount(lost, -d, minlength=size) + np.bincount(gained[has], d[has], minlength=size)
        return g * scale, r.sum()

    # curvature by power iteration on the data part, at the steepest logit
    x = np.ones(size) / np.sqrt(size)
    top = 1.0
    for _ in range(12):
        w = x * scale
        g = pairs.by_word(pairs.by_text(w) / (4 * n)) + l2 * w
        if len(pair):
            d = 2 * strength * change(w)[who] / n
            g += np.bincount(lost, -d, minlength=size) + np.bincount(gained[has], d[has], minlength=size)
        g *= scale
        top = max(float(np.linalg.norm(g)), 1e-9)
        x = g / top
    step = 1 / (1.2 * top + 0.25)
    v = u = np.zeros(size)
    b = c = float(np.log(share / (1 - share)))
    t = 1.0
    for _ in range(steps):
        gv, gb = gradient(u, c)
        new = u - step * gv
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1 * scale, 0)
        new_b = c - step * gb
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, c = new + (t - 1) / t_new * (new - v), new_b + (t - 1) / t_new * (new_b - b)
        v, b, t = new, new_b, t_new
    return v * scale, float(b)


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    """Score of each whole text, 0 to 1."""
    w = lexical_words_of(texts)
    hashes = hash_words(w.vocab)
    z = np.full(len(texts), model.bias)
    if len(model.words) and len(hashes):
        at = np.minimum(np.searchsorted(model.words, hashes), len(model.words) - 1)
        weight = np.where(model.words[at] == hashes, model.weights[at], 0.0)
        hit = weight[w.idx] != 0
        pairs = np.unique(w.doc[hit] * np.int64(len(hashes)) + w.idx[hit])
        doc, word = np.divmod(pairs, len(hashes))
        z += np.bincount(doc, weight[word], minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def held_out(doc_id: Column, modulus: int, left_out: int) -> Column:
    """Whether a row's remainder is the one that is never learned from (false for a null id)."""
    return F.coalesce(remainder(doc_id, modulus) == left_out, F.lit(False))


def score_table(docs: DataFrame, score, modulus: int, left_out: int, threshold: float) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; ``score`` maps an
    Arrow array of texts to an array of scores inside a task."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield record_batch(schema, [batch.column(0), batch.column(1), score(batch.column(2))])

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id, modulus, left_out).alias("held_out"), "text")
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    return score_table(docs, lambda texts: scores(texts, model.value), MODULUS, LEFT_OUT, threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(scores(batch.column(at), model.value) < threshold))

    return docs.mapInArrow(keep, docs.schema)
