"""Language-model scores against a plain backoff model in dictionaries."""

import math
import zlib

import numpy as np
import pytest

from quarry.llm import backoff_lm
from llm import reference_lm


def close(a, b, abs_tol=1e-9):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=abs_tol)


@pytest.fixture(scope="module")
def model(texts):
    return reference_lm.model_of([(d, t, 1) for d, t in texts.items()])


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_the_plain_model(docs, texts, model, monkeypatch, small):
    """Also with many chunks and buckets, short pieces, and a short hash so
    short that most n-grams share one."""
    if small:
        monkeypatch.setattr(backoff_lm, "CHUNK_BYTES", 1 << 16)
        monkeypatch.setattr(backoff_lm, "BUCKET_KEYS", 1 << 12)
        monkeypatch.setattr(backoff_lm, "PIECE", 7)
    got = {r.doc_id: r for r in backoff_lm.score(docs).collect()}
    assert len(got) == len(texts)
    for d, t in texts.items():
        words, r = reference_lm.tokens_of(t), got[d]
        assert close(r.score, model.score(words)) and close(r.base_score, model.base(words))
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(words) + 1, model.total, zlib.crc32(str(d).encode()) % 10 == 0)
        assert r.n_known == sum(model.one[w] > 0 for w in [*words, reference_lm.END])


def test_the_automaton_beats_the_base_on_held_out_texts(docs):
    rows = [r for r in backoff_lm.score(docs).collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_the_plain_model_is_a_distribution(model):
    words = [*model.one]
    unseen = reference_lm.SMOOTH / (model.total + reference_lm.SMOOTH * (model.distinct + 1))
    pairs = sorted(model.two, key=lambda g: (-model.two[g], str(g)))[:3]
    for history in [(), (reference_lm.END,), *((a,) for a, _ in pairs), *pairs]:
        if history and history[-1] is reference_lm.END and len(history) > 1:
            continue
        other = unseen * math.prod(model.alpha.get(history[i:], 1.0) for i in range(len(history)))
        assert math.isclose(sum(model.p(w, history) for w in words) + other, 1.0, rel_tol=1e-9)


def test_ngrams_seen_twice_count_in_a_large_corpus(spark):
    usual = " ".join(f"w{i % 50} v{i % 7}" for i in range(10_000))
    rare = "an uncommon phrase of few words"
    rows = [(1, usual, 250), (2, rare, 2), (3, f"w1 {rare} v3", 1)]  # 5 million tokens
    table = [(d, t) for d, t, k in rows for _ in range(k)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(table, 8), "doc_id long, text string")
    got = {r.doc_id: r.score for r in backoff_lm.score(df).collect()}
    plain = reference_lm.model_of(rows)
    # the words' own part of the long text is a sum of 30,000, which leaves so much of rounding
    assert all(close(got[d], plain.score(reference_lm.tokens_of(t)), 1e-5) for d, t, _ in rows)


def test_nothing_to_learn_from(spark):
    left_out = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 10 == 0)
    got = backoff_lm.score(spark.createDataFrame([(left_out, "a b c"), (None, "a b"), (None, None)], "doc_id long, text string")).collect()
    assert [(r.score, r.base_score, r.train_tokens, r.n_known) for r in got] == [(0.0, 0.0, 0, 0)] * 3
    assert sorted(r.n_tokens for r in got) == [1, 3, 4] and {r.held_out for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_packed_numbers_come_back(n):
    rng = np.random.default_rng(n)
    for values in (np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64)), rng.integers(0, 9, n).astype(np.int32), rng.normal(size=n)):
        assert (backoff_lm.unpacked(backoff_lm.packed(values), n, values.dtype) == values).all()


def test_a_walk_in_pieces_equals_a_walk_at_once(monkeypatch):
    """A small automaton with bigram states, on one long text."""
    part = backoff_lm.Part(
        c1=np.array([9, 8, 7, 1]), two=None, w1=np.array([0, 1, 2]), w2=np.array([1, 0, 0]), c2=np.array([5, 4, 3]), mine2=None,
        left=np.array([0, 1]), right=np.array([1, 0]), w3=np.array([0, 1]), c3=np.array([3, 2]), mine3=None, words=None, pairs=None,
    )
    machine = backoff_lm.Automaton(part, np.log10([0.4, 0.3, 0.2, 0.1]), np.array([-0.1, -0.2, -0.3, 0.0]), np.array([-0.4, -0.5, 0.0]))
    rng = np.random.default_rng(1)
    tokens = np.concatenate([[3], rng.integers(0, 3, 500), [3], [3], [0], [3]])
    starts, lens = np.array([0, 502]), np.array([500, 1])
    whole = machine.traverse(tokens, starts, lens)
    monkeypatch.setattr(backoff_lm, "PIECE", 3)
    assert np.allclose(machine.traverse(tokens, starts, lens), whole, rtol=1e-12)
