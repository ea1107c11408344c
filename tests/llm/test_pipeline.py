"""The registered queries, and the pipeline against a brute-force version of its stages."""

import numpy as np
import pyarrow as pa
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm import near_dup, secret_scan, toxicity
from quarry.llm.common import hash_words, lexical_words_of

SF001 = "/root/testdata/sf0.001"


def test_thirteen_operators_and_pipeline_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


def kept_of_each_class(texts):
    """Least id of every class, from all pairs."""
    ids, batch = list(texts), pa.array(list(texts.values()))
    w = lexical_words_of(batch)
    df = np.bincount(np.unique(w.doc * len(w.vocab) + w.idx) % len(w.vocab), minlength=len(w.vocab))
    hashes, n = hash_words(w.vocab), len(ids)
    order = np.argsort(hashes)
    common = order[df[order] * near_dup.RARE >= n]
    idf = near_dup.Idf(hashes[common], np.log((n + 1) / df[common]), float(np.log(min(n, near_dup.RARE) + 1)))
    s = near_dup.weighted_sets(batch, idf)
    sets = [(s.shingles[a : a + m], s.weights[a : a + m]) for a, m in zip(s.starts, s.lens)]
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            if root[i] != root[j] and len(sets[i][0]) and len(sets[j][0]) and near_dup.weighted_jaccard(sets[i], sets[j]) >= near_dup.SIMILARITY:
                old = max(root[i], root[j])
                root = [min(root[i], root[j]) if r == old else r for r in root]
    return {min(ids[k] for k in range(n) if root[k] == r) for r in set(root)}


def test_pipeline_equals_brute_force(spark, docs, texts, labels, benchmark, piece_path):
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF001).collect()}
    model = toxicity.fit(docs, labels)
    scores = toxicity.scores(pa.array(list(texts.values())), model)
    left = {d: t for (d, t), s in zip(texts.items(), scores) if s < toxicity.THRESHOLD}
    assert len(left) < len(texts)
    first = kept_of_each_class(left)
    assert len(first) < len(left)
    items = [r.text for r in benchmark.collect()]
    left = {d: t for d, t in left.items() if d in first and not any(i in t for i in items)}
    assert set(rows) == set(left) and len(left) < len(first)
    reference = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    for d, text in left.items():
        spans = [(a, b) for a, _, b in secret_scan.base_spans(text)]
        for a, b in sorted(spans, reverse=True):
            if not any(x <= a and b <= y and (x, y) != (a, b) for x, y in spans):
                text = text[:a] + "[secret]" + text[b:]
        assert rows[d].token_ids == reference.encode(text) and rows[d].n_tokens == len(rows[d].token_ids) and rows[d].parity
