"""Operator 10: language-model scores from a weighted backoff automaton.

Tokens are the words of a text (ASCII letters lower-cased) and one end.  From
the texts that may be learned from come exact counts of all words, and of all
bigrams and trigrams that occur at least ``LEAST`` times; that cutoff is the
same for a corpus of any size, so the model grows with the corpus.  It backs
off:

    P(w | h) = (c(h w) - D) / c(h)          for a kept n-gram h w
             = alpha(h) P(w | h without its first word)   otherwise
    P(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))

with alpha(h) such that P(. | h) sums to one.  Kept histories are states, kept
n-grams arcs, and a failure arc with weight alpha(h) leads from each state to
that of its shorter history.  A text starts in the state after an end; one
traversal from left to right carries the state and adds log10 probabilities.

The automaton is never whole in one place.  A *chunk* (the texts of one slice)
gets the states and arcs that its texts can reach, in three rounds of questions.
In each, a chunk sends its distinct keys to ``buckets`` by hash, one row of
packed arrays a bucket, and gets one answer a key back:

* words: their counts; bigrams and trigrams: whether a short hash of them can
  occur ``LEAST`` times (those of which it cannot are not sent again);
* the other bigrams and trigrams: their counts, and one chunk is told to
  account for each kept n-gram;
* words and kept bigrams as histories that a text fails from, with the sums of
  counts over the accounted n-grams: the sums over all, which give alpha.  All
  terms of a history have one denominator, so these sums are integers.

Then each chunk builds its part of the automaton and walks its texts, all side
by side, carrying a state each; a long text is walked in pieces, which start in
the state that the two tokens before them lead to.

Scale: keys travel sorted, as differences; a round ships a few bytes a distinct
n-gram of a chunk, so a hot one has one entry a chunk, and nothing is
broadcast.  A task holds one chunk or one bucket; the number of buckets grows
with the tokens.  The bits of the short hash grow with the logarithm of the
tokens.  N-grams are told apart by 64-bit hashes.  Shuffle files of finished
rounds are given back at once.

Defined results: a null or empty text has its end alone; rows of equal id are
scored apart and all learned from; a null id is never learned from nor held
out; without training rows N and V are 0 and every token has probability 1;
an empty table gives no rows.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, mix, record_batch, slices, training_row, words_of
from quarry.llm.toxicity import held_out

MODULUS, LEFT_OUT = 10, 0
SMOOTH, DISCOUNT = 0.1, 0.5
#: Least count of a kept n-gram, whatever the size of the corpus.
LEAST = 2
#: Text of a chunk, which is scored at once in a task.
CHUNK_BYTES = 4 << 20
#: Distinct n-grams that a bucket is meant for.
BUCKET_KEYS = 1 << 22
LEAST_BUCKETS = 8
#: Bits of a short hash beyond those that number the tokens.
SPARE_BITS = 4
#: Tokens of a text walked in one go.
PIECE = 512
END_NUMBER = 0


# -- packed arrays ---------------------------------------------------------

CODEC = pa.Codec("zstd", 1)


def packed(values: np.ndarray) -> bytes:
    """The bytes of equal rank of all numbers lie together, compressed."""
    return CODEC.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), asbytes=True) if len(values) else b""


def unpacked(data: bytes, n: int, dtype, numbers: int = 1) -> np.ndarray:
    """``n`` numbers, or rows of so many numbers."""
    width = np.dtype(dtype).itemsize * numbers
    shape = n if numbers == 1 else (n, numbers)
    if not n:
        return np.zeros(shape, dtype)
    planes = np.frombuffer(CODEC.decompress(data, n * width, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(dtype).reshape(shape)


def steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=np.uint64(0))


# -- chunks ----------------------------------------------------------------

CHUNK_DDL = "chunk long, doc_id array<long>, held_out array<boolean>, learn array<boolean>, lens array<int>, vocab binary, vocab_bytes long, n long, idx binary, tokens long"
CHUNK = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("learn", pa.list_(pa.bool_())),
    ("lens", pa.list_(pa.int32())), ("vocab", pa.binary()), ("vocab_bytes", pa.int64()), ("n", pa.int64()), ("idx", pa.binary()), ("tokens", pa.int64()),
])


def chunk_table(docs: DataFrame) -> DataFrame:
    """One row a chunk: its texts as places in the chunk's list of words (joined
    by spaces, most frequent first), and the number of its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in slices(batches, max_bytes=CHUNK_BYTES):
            w = words_of(batch.column(3), lower_ascii=True)
            order = np.argsort(-np.bincount(w.idx, minlength=len(w.vocab)), kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            words = np.frombuffer(" ".join(w.vocab.take(pa.array(order)).to_pylist()).encode(), np.uint8)
            lists = [*(batch.column(i).to_pylist() for i in range(3)), w.lens.tolist()]
            yield record_batch(CHUNK, [[chunk], *[[v] for v in lists], [packed(words)], [len(words)], [len(w.idx)], [packed(place[w.idx])], [len(w.idx) + batch.num_rows]])
            chunk += 1

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id, MODULUS, LEFT_OUT).alias("held_out"), training_row(doc_id, MODULUS, LEFT_OUT).alias("learn"), "text")
    return rows.mapInArrow(run, CHUNK_DDL)


def join_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a + np.uint64(0x9E3779B97F4A7C15)) + b)


@dataclass
class Distinct:
    """The distinct n-grams of a chunk, by key: where each first begins, and
    how often it occurs in texts learned from."""

    key: np.ndarray
    at: np.ndarray
    c: np.ndarray
    place: np.ndarray  # by token: the place here of the n-gram that begins there, -1 for none

    @classmethod
    def of(cls, key: np.ndarray, position: np.ndarray, learned: np.ndarray, n_tokens: int) -> Distinct:
        order = np.argsort(key)
        key, by_key = key[order], position[order]
        cut = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        place = np.full(n_tokens, -1, np.int64)
        place[by_key] = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(key))))
        return cls(key[cut], by_key[cut], np.add.reduceat(learned[by_key], cut) if len(cut) else np.zeros(0, np.int64), place)

    def pick(self, which: np.ndarray) -> Distinct:
        moved = np.append(np.where(which, np.cumsum(which) - 1, -1), -1)
        return Distinct(self.key[which], self.at[which], self.c[which], moved[self.place])


class Chunk:
    """The tokens of a chunk (an end before and after each text) and its n-grams."""

    def __init__(self, row: dict):
        self.row, self.id = row, row["chunk"]
        vocab = unpacked(row["vocab"], row["vocab_bytes"], np.uint8).tobytes().split()
        self.end = len(vocab)
        digest = xxhash.xxh64_intdigest
        self.number = np.fromiter((*(digest(w) for w in vocab), END_NUMBER), np.uint64, len(vocab) + 1)
        lens = np.array(row["lens"], np.int64)
        self.text = np.repeat(np.arange(len(lens)), lens + 2)
        self.tokens = np.full(int(lens.sum()) + 2 * len(lens), self.end, np.int64)
        self.tokens[np.arange(int(lens.sum())) + 2 * np.repeat(np.arange(len(lens)), lens) + 1] = unpacked(row["idx"], row["n"], np.uint32)
        self.starts = np.cumsum(lens + 2) - lens - 2  # of the end before each text
        self.lens = lens
        learned = np.array(row["learn"], np.int64)[self.text] if len(lens) else np.zeros(0, np.int64)
        counted = learned.copy()
        counted[self.starts] = 0  # the end before a text is not counted
        c = np.bincount(self.tokens, counted, minlength=self.end + 1).astype(np.int64)
        key = mix(self.number)
        order = np.argsort(key)
        self.words = Distinct(key[order], order, c[order], self.tokens)  # ``at`` is the word's place
        self._learned = learned

    def grams(self) -> tuple[Distinct, Distinct]:
        n = self.number[self.tokens]
        two = join_keys(n[:-1], n[1:])
        three = join_keys(two[:-1], two[1:])
        at2, at3 = np.flatnonzero(self.text[:-1] == self.text[1:]), np.flatnonzero(self.text[:-2] == self.text[2:])
        return tuple(Distinct.of(k[at], at, self._learned, len(n)) for k, at in ((two, at2), (three, at3)))


# -- questions and answers ---------------------------------------------------

ASK_DDL = "bucket long, n int, chunk long, m long, keys binary, numbers binary"
ASK = pa.schema([("bucket", pa.int64()), ("n", pa.int32()), ("chunk", pa.int64()), ("m", pa.int64()), ("keys", pa.binary()), ("numbers", pa.binary())])
ANSWER_DDL = "step int, n int, chunk long, bucket long, m long, data binary"
ANSWER = pa.schema([("step", pa.int32()), ("n", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int64()), ("m", pa.int64()), ("data", pa.binary())])


def ask(chunk: int, n: int, key: np.ndarray, shift: int, numbers: np.ndarray) -> pa.RecordBatch:
    """Sorted ``key`` (its bucket lies above ``shift``) with its numbers (one
    or a row of them a key), a row a bucket."""
    bucket = key >> np.uint64(shift)
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    ends = np.append(cut[1:], len(key)).astype(np.int64)[: len(cut)]
    base = bucket[cut] << np.uint64(shift)
    parts = list(zip(cut.tolist(), ends.tolist(), strict=True))
    return record_batch(ASK, [
        bucket[cut].astype(np.int64), np.full(len(cut), n, np.int32), np.full(len(cut), chunk), ends - cut,
        [packed(steps(key[a:b] - base[i])) for i, (a, b) in enumerate(parts)], [packed(numbers[a:b]) for a, b in parts],
    ])


def answered(asks: DataFrame, step: int, buckets: int, shift: Callable[[int], int], answer: Callable) -> DataFrame:
    """Answer rows: the numbers of each key are summed over a bucket's
    questions; ``answer(n, sums)`` gives the value of every key, and each chunk
    gets those of its keys in the order of its question."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        bucket = table["bucket"][0].as_py()
        rows = table.to_pylist()
        for n in sorted({r["n"] for r in rows}):
            own = sorted((r for r in rows if r["n"] == n), key=lambda r: r["chunk"])
            keys = np.concatenate([np.cumsum(unpacked(r["keys"], r["m"], np.uint64)) for r in own]) + (np.uint64(bucket) << np.uint64(shift(n)))
            lens = np.array([r["m"] for r in own])
            numbers = np.concatenate([unpacked(r["numbers"], r["m"], answer.dtype, answer.width) for r in own]).astype(np.int64)
            order = np.argsort(keys)
            cut = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
            group = np.empty(len(keys), np.int64)
            group[order] = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(keys))))
            values, extra = answer(n, np.add.reduceat(numbers[order], cut))
            reply = values[group]
            if answer.marks_first:  # the first chunk that asks accounts for it
                first = np.zeros(len(keys), np.int64)
                first[np.minimum.reduceat(order, cut)] = 1
                reply = np.where(reply > 0, reply * 2 + first, 0)
            at = np.concatenate([[0], np.cumsum(lens)]).tolist()
            data = [np.packbits(reply[a:b]).tobytes() if reply.dtype == bool else packed(reply[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            m = len(own)
            out.append(record_batch(ANSWER, [np.full(m, step, np.int32), np.full(m, n, np.int32), [r["chunk"] for r in own], np.full(m, bucket), lens, data]))
            if extra is not None:
                out.append(record_batch(ANSWER, [[step], [0], [-1], [bucket], [extra], [b""]]))
        return pa.Table.from_batches(out, ANSWER)

    return asks.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(run, ANSWER_DDL)


class Count:
    """Counts of words; whether the short hash of an n-gram can occur ``LEAST`` times."""

    dtype, width, marks_first = np.int32, 1, False

    def __call__(self, n: int, sums: np.ndarray) -> tuple[np.ndarray, int | None]:
        return (sums, int((sums > 0).sum())) if n == 1 else (sums >= LEAST, None)


class Keep:
    """Counts of n-grams that occur ``LEAST`` times, 0 for others."""

    dtype, width, marks_first = np.int32, 1, True

    def __call__(self, n: int, sums: np.ndarray) -> tuple[np.ndarray, None]:
        return np.where(sums >= LEAST, sums, 0), None


class Totals:
    """Of each history the kept n-grams, their counts, and those of what they
    are without their first word."""

    dtype, width, marks_first = np.int64, 3, False

    def __call__(self, n: int, sums: np.ndarray) -> tuple[np.ndarray, None]:
        return sums, None


@dataclass
class Answers:
    """A chunk's answers of all steps so far."""

    rows: list[dict]

    def get(self, step: int, n: int, dtype, numbers: int = 1) -> np.ndarray:
        rows = [r for r in self.rows if r["step"] == step and r["n"] == n]
        rows.sort(key=lambda r: r["bucket"])
        if dtype is bool:
            return np.concatenate([np.zeros(0, bool), *[np.unpackbits(np.frombuffer(r["data"], np.uint8))[: r["m"]].astype(bool) for r in rows]])
        return np.concatenate([unpacked(b"", 0, dtype, numbers), *[unpacked(r["data"], r["m"], dtype, numbers) for r in rows]])


@dataclass
class Plan:
    """What all tasks know: sizes of the corpus and the buckets."""

    buckets_bits: int
    short_bits: int
    total: int = 0  # N
    distinct: int = 0  # V

    def shift(self, n: int) -> int:
        return 64 - self.buckets_bits

    def short_shift(self, n: int) -> int:
        return 64 - self.buckets_bits if n == 1 else self.short_bits - self.buckets_bits

    def log_p(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + SMOOTH) / (self.total + SMOOTH * (self.distinct + 1)))


def per_chunk(chunks: DataFrame, answers: DataFrame, tasks: int, run: Callable[[Chunk, Answers], Iterator[pa.RecordBatch]], ddl: str, schema: pa.Schema) -> DataFrame:
    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        batches = [b for row in left.to_pylist() for b in run(Chunk(row), Answers(right.to_pylist()))]
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches(batches, schema)

    sides = [t.repartition(tasks, "chunk").groupBy("chunk") for t in (chunks, answers)]
    return sides[0].cogroup(sides[1]).applyInArrow(both, ddl)


# -- the rounds ----------------------------------------------------------------


def first_questions(chunks: DataFrame, plan: Plan) -> DataFrame:
    """All words, and the short hashes of all bigrams and trigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                yield ask(chunk.id, 1, chunk.words.key, plan.shift(1), chunk.words.c.astype(np.int32))
                for n, d in zip((2, 3), chunk.grams(), strict=True):
                    short, cut = shortened(d.key, plan.short_bits)
                    c = np.add.reduceat(d.c, cut) if len(cut) else d.c
                    yield ask(chunk.id, n, short, plan.short_shift(n), np.minimum(c, LEAST).astype(np.int32))
                pa.default_memory_pool().release_unused()

    return chunks.mapInArrow(run, ASK_DDL)


def shortened(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct first ``bits`` of sorted keys, and where each begins."""
    short = key >> np.uint64(64 - bits)
    cut = np.flatnonzero(np.append(True, short[1:] != short[:-1])[: len(short)])
    return short[cut], cut


def candidates(chunk: Chunk, told: Answers, plan: Plan) -> tuple[Distinct, Distinct]:
    """Bigrams and trigrams that can be kept, as far as short hashes tell; a
    trigram's bigrams must be among them."""
    out = []
    for n, d in zip((2, 3), chunk.grams(), strict=True):
        _, cut = shortened(d.key, plan.short_bits)
        out.append(d.pick(np.repeat(told.get(1, n, bool), np.diff(np.append(cut, len(d.key))))))
    two, three = out
    return two, three.pick((two.place[three.at] >= 0) & (two.place[three.at + 1] >= 0))


def second_questions(chunks: DataFrame, answers: DataFrame, plan: Plan, tasks: int) -> DataFrame:
    def run(chunk: Chunk, told: Answers) -> Iterator[pa.RecordBatch]:
        for n, d in zip((2, 3), candidates(chunk, told, plan), strict=True):
            yield ask(chunk.id, n, d.key, plan.shift(n), d.c.astype(np.int32))

    return per_chunk(chunks, answers, tasks, run, ASK_DDL, ASK)


@dataclass
class Part:
    """The states and arcs that a chunk can reach.  Places are those of words;
    ``left`` and ``right`` of a trigram are its bigrams' places in ``two``."""

    c1: np.ndarray  # by place
    two: Distinct
    w1: np.ndarray
    w2: np.ndarray
    c2: np.ndarray
    mine2: np.ndarray
    left: np.ndarray
    right: np.ndarray
    w3: np.ndarray
    c3: np.ndarray
    mine3: np.ndarray
    words: np.ndarray  # histories to ask for, in order of their keys: words
    pairs: np.ndarray  # and bigrams


def part_of(chunk: Chunk, told: Answers, plan: Plan) -> Part:
    c1 = np.empty(len(chunk.number), np.int64)
    c1[chunk.words.at] = told.get(1, 1, np.int64)
    two, three = candidates(chunk, told, plan)
    got2, got3 = told.get(2, 2, np.int64), told.get(2, 3, np.int64)
    two, three, got2, got3 = two.pick(got2 > 0), three.pick(got3 > 0), got2[got2 > 0], got3[got3 > 0]
    mine2, mine3 = (got2 & 1).astype(bool), (got3 & 1).astype(bool)
    w1, w2 = chunk.tokens[two.at], chunk.tokens[two.at + 1]
    left, right = (two.place[three.at + i] for i in (0, 1))
    # a history is asked for where a text fails from it, or to account for its n-grams
    asked1, asked2 = np.zeros(len(c1), bool), np.zeros(len(w1), bool)
    asked1[w1[mine2]] = True
    asked2[left[mine3]] = True
    same = np.append(chunk.text[:-1] == chunk.text[1:], False)
    asked1[chunk.tokens[same & (two.place < 0)]] = True
    further = np.append(same[1:], False) & same & (two.place >= 0) & (three.place < 0)
    asked2[two.place[further]] = True
    order = chunk.words.at
    return Part(
        c1, two, w1, w2, got2 >> 1, mine2, left, right, chunk.tokens[three.at + 2], got3 >> 1, mine3,
        order[asked1[order] & (c1[order] >= LEAST)], np.flatnonzero(asked2),
    )


def third_questions(chunks: DataFrame, answers: DataFrame, plan: Plan, tasks: int) -> DataFrame:
    def sums(history: np.ndarray, size: int, *numbers: np.ndarray) -> np.ndarray:
        out = np.zeros((size, 1 + len(numbers)), np.int64)
        for i, v in enumerate((np.ones(len(history), np.int64), *numbers)):
            np.add.at(out[:, i], history, v)
        return out

    def run(chunk: Chunk, told: Answers) -> Iterator[pa.RecordBatch]:
        part = part_of(chunk, told, plan)
        mine = part.mine2
        one = sums(part.w1[mine], len(part.c1), part.c2[mine], part.c1[part.w2[mine]])
        yield ask(chunk.id, 1, mix(chunk.number)[part.words], plan.shift(1), one[part.words])
        mine = part.mine3
        two = sums(part.left[mine], len(part.w1), part.c3[mine], part.c2[part.right[mine]])
        yield ask(chunk.id, 2, part.two.key[part.pairs], plan.shift(2), two[part.pairs])

    return per_chunk(chunks, answers, tasks, run, ASK_DDL, ASK)


def failures(part: Part, told: Answers, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """log10 alpha of words (by place) and of kept bigrams; 0 where not asked for."""

    def alpha(own: np.ndarray, lower: np.ndarray, n: np.ndarray) -> np.ndarray:
        left = [np.maximum(1 - v, 1e-12) for v in (own, lower)]
        return np.where(n > 0, np.log10(left[0] / left[1]), 0.0)

    one, two = np.zeros(len(part.c1)), np.zeros(len(part.w1))
    n, c, lower = told.get(3, 1, np.int64, 3).T
    one[part.words] = alpha((c - DISCOUNT * n) / part.c1[part.words], (lower + SMOOTH * n) / (plan.total + SMOOTH * (plan.distinct + 1)), n)
    n, c, lower = told.get(3, 2, np.int64, 3).T
    two[part.pairs] = alpha((c - DISCOUNT * n) / part.c2[part.pairs], (lower - DISCOUNT * n) / part.c1[part.w2[part.pairs]], n)
    return one, two


# -- the automaton --------------------------------------------------------------


class Automaton:
    """State 0 is the empty history, state 1 + w that of a word, and the kept
    bigrams follow.  ``keys`` are the arcs beyond the root (state and word);
    the root has an arc for every word.  Failure arcs lead from ``state`` to
    ``lower[state]`` and weigh ``back[state]``."""

    def __init__(self, part: Part, log_p1: np.ndarray, alpha1: np.ndarray, alpha2: np.ndarray):
        self.words = len(log_p1)
        self.root = log_p1
        first = 1 + self.words
        keys = np.concatenate([(1 + part.w1) * self.words + part.w2, (first + part.left) * self.words + part.w3])
        order = np.argsort(keys)
        self.keys = keys[order]
        p2 = (part.c2 - DISCOUNT) / part.c1[part.w1]
        p3 = (part.c3 - DISCOUNT) / part.c2[part.left]
        self.weight = np.log10(np.concatenate([p2, p3]))[order]
        self.next = np.concatenate([first + np.arange(len(part.w1)), first + part.right])[order]
        self.back = np.concatenate([[0.0], alpha1, alpha2])
        self.lower = np.concatenate([np.zeros(first, np.int64), 1 + part.w2])

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights and next states of reading one word in each of many states:
        failure arcs are followed until an arc or the root reads it."""
        weight, after = np.zeros(len(state)), 1 + word
        todo = np.arange(len(state))
        while len(todo):
            s, w = state[todo], word[todo]
            at_root = s == 0
            weight[todo[at_root]] += self.root[w[at_root]]
            todo, s, w = todo[~at_root], s[~at_root], w[~at_root]
            if not len(todo) or not len(self.keys):
                hit = np.zeros(len(todo), bool)
            else:
                want = s * self.words + w
                at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
                hit = self.keys[at] == want
                weight[todo[hit]] += self.weight[at[hit]]
                after[todo[hit]] = self.next[at[hit]]
            todo, s = todo[~hit], s[~hit]
            weight[todo] += self.back[s]
            state[todo] = self.lower[s]
        return weight, after

    def traverse(self, tokens: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Sum of each text's weights.  ``tokens[starts]`` are the ends before
        the texts of ``lens`` words; the end after each is read too."""
        pieces = -(-(lens + 1) // PIECE)
        text = np.repeat(np.arange(len(lens)), pieces)
        inner = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[text] + 1 + inner * PIECE
        size = np.minimum(lens[text] + 1 - inner * PIECE, PIECE)
        state = 1 + tokens[begin - 1]  # after the end before the text
        later = np.flatnonzero(inner > 0)
        if len(later):
            state[later] = self.step(1 + tokens[begin[later] - 2], tokens[begin[later] - 1])[1]
        order = np.argsort(-size, kind="stable")
        begin, size, state = begin[order], size[order], state[order]
        total = np.zeros(len(begin))
        running = np.searchsorted(-size, -np.arange(1, int(size.max(initial=0)) + 1), "right")
        for k, m in enumerate(running.tolist()):
            weight, state[:m] = self.step(state[:m].copy(), tokens[begin[:m] + k])
            total[:m] += weight
        return np.bincount(text[order], total, minlength=len(lens))


SUMS_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
SUMS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def traversed(chunks: DataFrame, answers: DataFrame, plan: Plan, tasks: int) -> DataFrame:
    def run(chunk: Chunk, told: Answers) -> Iterator[pa.RecordBatch]:
        part = part_of(chunk, told, plan)
        log_p1 = plan.log_p(part.c1)
        scores = Automaton(part, log_p1, *failures(part, told, plan)).traverse(chunk.tokens, chunk.starts, chunk.lens)
        read = np.ones(len(chunk.tokens), bool)
        read[chunk.starts] = False
        at, w = chunk.text[read], chunk.tokens[read]
        n = len(chunk.lens)
        base = np.bincount(at, log_p1[w], minlength=n)
        known = np.bincount(at, part.c1[w] > 0, minlength=n).astype(np.int64)
        yield record_batch(SUMS, [chunk.row["doc_id"], chunk.row["held_out"], chunk.lens + 1, known, base, scores])

    return per_chunk(chunks, answers, tasks, run, SUMS_DDL, SUMS)


def give_back(scratch: Scratch) -> None:
    """Let Spark drop the shuffle files of frames that nobody holds any more: its
    cleaner acts on what the driver's garbage collector finds, in two turns."""
    gc.collect()
    for _ in range(2):
        scratch.spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    chunks = scratch.store(chunk_table(docs), "chunks")
    size = chunks.agg(F.sum("tokens").alias("tokens"), F.count("*").alias("chunks")).first()
    tokens = size.tokens or 0
    bits = max(LEAST_BUCKETS, 2 * tokens // BUCKET_KEYS + 1)
    bits = (bits - 1).bit_length()
    plan = Plan(bits, min(64, max(bits, tokens.bit_length() + SPARE_BITS)))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size.chunks // 2)

    told = scratch.store(answered(first_questions(chunks, plan), 1, 1 << bits, plan.short_shift, Count()), "first")
    give_back(scratch)
    # each text learned from is a sum of its words and its end
    learned = told.filter("chunk < 0").agg(F.sum("m").alias("v")).first()
    counted = F.aggregate(F.arrays_zip("lens", "learn"), F.lit(0).cast("long"), lambda n, x: n + F.when(x["learn"], x["lens"] + 1).otherwise(0))
    plan.distinct = int(learned.v or 0)
    plan.total = int(chunks.agg(F.sum(counted).alias("n")).first().n or 0)

    told = told.filter("chunk >= 0")
    told = told.unionByName(scratch.store(answered(second_questions(chunks, told, plan, tasks), 2, 1 << bits, plan.shift, Keep()), "second"))
    give_back(scratch)
    told = told.unionByName(scratch.store(answered(third_questions(chunks, told, plan, tasks), 3, 1 << bits, plan.shift, Totals()), "third"))
    give_back(scratch)
    rows = traversed(chunks, told, plan, tasks).withColumn("train_tokens", F.lit(plan.total).cast("long"))
    return scratch.finish(rows.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))
