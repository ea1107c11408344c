"""SimHash classes against brute force."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from quarry.llm import sim_hash
from quarry.llm.common import Scratch

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))


def components(prints, radius=4):
    """The least position that each fingerprint reaches, by plain search."""
    at = np.array(prints, np.uint64)
    label = list(range(len(at)))
    for i in range(len(at)):
        if label[i] == i:
            todo = [i]
            while todo:
                j = todo.pop()
                for k in np.flatnonzero(np.bitwise_count(at[j] ^ at) <= radius).tolist():
                    if label[k] == k and k > i:
                        label[k] = i
                        todo.append(k)
    return label


def test_matches_brute_force(docs, texts):
    ids = sorted(texts)
    prints = [fingerprint(texts[d]) for d in ids]
    label = components(prints)
    want = {(d, format(p, "016x"), ids[k]) for d, p, k in zip(ids, prints, label, strict=True)}
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in sim_hash.near_classes(docs).collect()} == want


def clouds(n, spread, seed=0):
    """Random fingerprints and, around each, others at a few flipped bits."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    near = [c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, size, replace=False))) for c in centres for size in spread]
    return np.unique(np.concatenate([centres, np.array(near, np.uint64)]))


@pytest.mark.parametrize("tile", [16, 2048])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, tile):
    """Chains, pairs at exactly 4 and 5 bits, and tiles of every fill."""
    monkeypatch.setattr(sim_hash, "TILE", tile)
    monkeypatch.setattr(sim_hash, "BLOCK", 8)
    values = clouds(200, [1, 2, 4, 5, 5, 6])
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    scratch = Scratch(spark)
    pairs = [(int(r.a) % (1 << 64), int(r.b) % (1 << 64)) for r in sim_hash.links(df, scratch).collect()]
    scratch.delete()
    assert all(bin(a ^ b).count("1") <= 4 for a, b in pairs)
    at = {int(v): i for i, v in enumerate(values)}
    top = list(range(len(values)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        x, y = root(at[a]), root(at[b])
        top[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(values))] == components(values)


def test_a_dense_group_gives_fewer_links_than_members():
    values = clouds(1, [1, 1, 2, 2] * 200)
    links = sim_hash.forest(values, values, True)
    assert len(links) == len(values) - 1


def test_a_text_of_more_shingles_than_a_lane_counts():
    import pyarrow as pa

    text = "a b c d " * 40_000 + "e f g h"
    assert sim_hash.simhash(pa.array([text, None, "x Y", "the " + text])).tolist() == [fingerprint(t) for t in (text, "", "x y", "the " + text)]


def test_edges(spark, odd, empty):
    rows = sim_hash.near_classes(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.select("doc_id").collect())
    # null, empty and blank texts: fingerprint zero, one class; the null id is left aside
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert Counter(r.doc_id for r in zero) == Counter({None: 1, 1: 2, 2: 1, 7: 1}) and {r.component_id for r in zero} == {1}
    assert {r.component_id for r in rows if r.doc_id in (3, 4)} == {3} and {r.component_id for r in rows if r.doc_id == 5} == {5}
    assert {r.component_id for r in rows if r.doc_id == 6} == {5, 6}
    assert sim_hash.near_classes(empty).collect() == []


def test_a_third_of_all_rows_in_one_fingerprint(spark):
    rows = [(None if i % 7 == 0 else i, "one hot text that many rows share") for i in range(1500)] + [(10_000 + i, f"text number {i} of its own kind {i * i}") for i in range(3000)]
    got = sim_hash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    hot = [r for r in got if r.copies >= 1500]
    assert len(hot) == 1500 and {r.component_id for r in hot} == {1}
