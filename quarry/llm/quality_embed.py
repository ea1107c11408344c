"""Operator 6: supervised subword embeddings for document quality.

Every word (with its case and marks) and every character n-gram of it, with
word ends marked, is hashed to a row of an embedding table; a text's vector is
the average of the rows of all its words and n-grams, and a softmax layer
gives the class probabilities.  Table and layer are learned together by
stochastic gradient descent in numpy, one text at a time.

Fit: at most ``sample`` labelled rows (the lowest hashes of their ids among
the rows that may be learned from) reach the driver, as counts of hashed
features of their whole texts.

Scale: with two classes the layer's score of a text is the average of one
number a table row, so scoring broadcasts ``BUCKETS`` numbers (a fixed bound)
and needs one map-only pass in Arrow batches, in which each distinct word of a
batch is hashed once.

Defined results: a null or empty text gets the score of the bias alone;
repeated labels of an id count once, as quality 0 if any is; without labelled
rows of both kinds every score is the share of good ones (0.5 if there are
none); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import mix, per_text, record_batch, slices, words_of
from quarry.llm.toxicity import labelled_sample, score_table

SAMPLE = 4_000
THRESHOLD = 0.7
MODULUS, LEFT_OUT = 4, 2
BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
DIMENSIONS, EPOCHS, RATE, SEED = 8, 10, 0.5, 7
#: Least and largest code points that no character has, as word ends.
BEGIN, END = 0x110000, 0x110001


@dataclass
class Model:
    rows: np.ndarray  # a table row's part of the score, one number a bucket
    bias: float


def word_features(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all features of all words, number of features of each word)."""
    words = vocab.to_pylist()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lens)
    code = np.empty(int(ends[-1]), np.uint64)
    inner = np.ones(len(code), bool)
    inner[ends - 1] = inner[ends - lens] = False
    code[inner] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    code[ends - lens], code[ends - 1] = BEGIN, END
    word = np.repeat(np.arange(len(words)), lens)
    left = ends[word] - np.arange(len(code))  # characters up to the word's end
    buckets, owner = [], []
    factor = np.uint64(0x100000001B3)
    # the whole word: its characters' mixed sum, each tied to its place
    place = np.arange(len(code)) - (ends - lens)[word]
    whole = np.add.reduceat(mix(code * factor + place.astype(np.uint64)), ends - lens)
    buckets.append(mix(whole) % np.uint64(BUCKETS))
    owner.append(np.arange(len(words)))
    h = code
    for n in range(2, max(GRAMS) + 1):
        h = h[:-1] * factor + code[n - 1 :]
        if n in GRAMS:
            full = left[: len(h)] >= n
            buckets.append(mix(h[full] + np.uint64(n)) % np.uint64(BUCKETS))
            owner.append(word[: len(h)][full])
    buckets, owner = np.concatenate(buckets).astype(np.int64), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return buckets[order], np.bincount(owner, minlength=len(words))


def text_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct buckets and how often each occurs."""
    w = words_of(texts)
    buckets, sizes = word_features(w.vocab)
    first = np.cumsum(sizes) - sizes
    for a, n in zip(w.starts, w.lens, strict=True):
        word, times = np.unique(w.idx[a : a + n], return_counts=True)
        all_of = [buckets[first[i] : first[i] + sizes[i]] for i in word]
        flat = np.concatenate(all_of) if all_of else np.zeros(0, np.int64)
        count = np.bincount(flat, np.repeat(times, sizes[word]), minlength=BUCKETS)
        found = np.flatnonzero(count)
        yield found, count[found]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("buckets", pa.binary()), ("counts", pa.binary())])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = list(text_features(batch.column(1)))
            yield record_batch(schema, [batch.column(0), batch.column(2), [b.astype("<u2").tobytes() for b, _ in got], [c.astype("<u4").tobytes() for _, c in got]])

    # good is 1: an id labelled both ways counts as bad
    bad = labels.select("doc_id", (1 - F.col("quality")).alias("bad"))
    rows = labelled_sample(docs, bad, "bad", MODULUS, LEFT_OUT, sample).mapInArrow(features, "doc_id long, y int, buckets binary, counts binary")
    table = rows.groupBy("doc_id").agg(F.min(F.struct("y", "buckets", "counts")).alias("r")).select("doc_id", "r.*").toArrow().sort_by("doc_id")
    texts = [(np.frombuffer(b, "<u2").astype(np.int64), np.frombuffer(c, "<u4")) for b, c in zip(table["buckets"].to_pylist(), table["counts"].to_pylist(), strict=True)]
    return train(1 - table["y"].to_numpy(), texts)


def train(y: np.ndarray, texts: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """Learn from labels (1: good) and the counted buckets of each text."""
    share = float(np.mean(y)) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    rng = np.random.default_rng(SEED)
    table = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((2, DIMENSIONS), np.float32), np.log([1 - share, share])
    steps, done = EPOCHS * len(y), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            rate = RATE * (1 - done / steps)
            done += 1
            at, count = texts[i]
            part = (count / max(1, count.sum())).astype(np.float32)
            vector = part @ table[at] if len(at) else np.zeros(DIMENSIONS, np.float32)
            z = layer @ vector + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1  # now the gradient of the loss
            back = (p @ layer).astype(np.float32)
            layer -= rate * np.outer(p, vector).astype(np.float32)
            bias -= rate * 0.1 * p
            if len(at):
                # the rate is a text's, spread over its features by their share
                table[at] -= rate * np.outer(part / max(float(part.max()), 1e-9), back)
    return Model((table @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    """Probability of good quality of each whole text."""
    w = words_of(texts)
    buckets, sizes = word_features(w.vocab)
    sums = np.concatenate([[0.0], np.cumsum(model.rows[buckets], dtype=np.float64)])
    ends = np.cumsum(sizes)
    word = sums[ends] - sums[ends - sizes]
    total = per_text(word[w.idx], w.starts, w.lens)
    count = per_text(sizes[w.idx], w.starts, w.lens)
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + model.bias, -500, 500)))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    return score_table(docs, lambda texts: scores(texts, model.value), MODULUS, LEFT_OUT, threshold)
