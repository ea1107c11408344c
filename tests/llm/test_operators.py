"""Operators against brute force on the small documents."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from quarry.llm import backoff_lm, common, decontaminate, near_dup, quality_embed, secret_scan, spot_sigs, suffix_dedup, token_pack, toxicity
from quarry.llm.common import Scratch, hash_words, lexical_words_of, words_of
from quarry.llm.components import components

WORD = re.compile("[^\x20\x09-\x0D]+")


# -- 3: packed files ---------------------------------------------------------


@pytest.mark.parametrize("width", [1, 5, 13, 16, 17, 31, 32])
def test_bit_packing_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 64 * 7, dtype=np.uint64).astype(np.uint32)
    packed = token_pack.pack(ids, width)
    assert len(packed) == 7 * width
    assert (token_pack.unpack(packed, width) == ids).all()


def test_random_access(tmp_path):
    rng = np.random.default_rng(0)
    lens = rng.integers(0, 3000, 40)
    docs = [rng.integers(0, 49_408, n).astype(np.uint32) for n in lens]
    fs = pafs.LocalFileSystem()
    writer = token_pack.PackedWriter(fs.open_output_stream(str(tmp_path / "x")), token_pack.width_of(49_408))
    for a in range(0, 40, 7):
        part = docs[a : a + 7]
        writer.add(np.arange(a, a + len(part)), np.zeros(len(part), np.uint8), np.array([len(d) for d in part]), np.concatenate(part))
    assert writer.close() == (40, lens.sum())
    f = token_pack.PackedFile(fs.open_input_file(str(tmp_path / "x")))
    for i in (39, 0, 17, 18):
        assert (f.document(i) == docs[i]).all()
    assert (f.ids(5000, 9000) == np.concatenate(docs)[5000:9000]).all()
    assert f.width == 16 and f.n_ids == lens.sum()


def test_packed_documents_hold_the_library_ids(docs, texts, bpe_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe_path)
    got = {r.doc_id: r for r in token_pack.pack_documents(docs, bpe_path).collect()}
    start = 0
    for d in sorted(texts):
        ids = np.array([*tokenizer.encode(texts[d] or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_word_encoder_on_odd_texts(bpe_path):
    enc = token_pack.WordEncoder(bpe_path, cache_words=50)
    odd = ["It's Café-au-lait, 12.5% … naïve", "ΑΣ ὈΔΥΣΣΕΎΣ Σ", "a<|endoftext|>b <|ENDOFTEXT|>", "é  x y", "ǅ İstanbul ß ÀÉ", "don't, 'tis rock'n'roll's!!'s ..., x.,\ny", "", "  ", "日本語 テキスト \U0001f600"]
    ids, lens = enc.encode(pa.array(odd))
    ends = np.cumsum(lens)
    for i, t in enumerate(odd):
        assert ids[ends[i] - lens[i] : ends[i]].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, t


# -- 2: secrets ---------------------------------------------------------------


def test_secret_spans(docs, texts):
    got = {r.doc_id: r for r in secret_scan.scan(docs).collect()}
    for d, text in texts.items():
        text = text or ""
        found = [(m.start(), 0, m.end()) for m in secret_scan.ASSIGN.finditer(text) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        joined = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))
        assert got[d].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(got[d].spans.split(",")) | {""}
        assert (got[d].n_assign, got[d].n_access, got[d].n_hex) == tuple(Counter(k for _, k, _ in found)[k] for k in range(3))


def test_random_runs_are_found_and_words_are_not(spark):
    import random

    rnd = random.Random(3)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows = [(i, f"see the {''.join(rnd.choices(chars, k=48))} here") for i in range(60)]
    rows += [(100 + i, f"see the {'-'.join(rnd.choices(['there', 'notion', 'error', 'then', 'entered', 'rest'], k=6))} here") for i in range(60)]
    rows += [(200, "a" * 40), (201, "1234567890" * 4), (202, "abcdefghijklmnopqrstuvwxyz" * 2)]
    got = {r.doc_id: r for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i].n_random for i in range(60)) >= 50
    assert got[0].n_random == 0 or got[0].spans == "random:8:56"
    assert sum(got[i].n_random for i in range(100, 160)) == 0
    assert got[200].n_random == got[201].n_random == got[202].n_random == 0


def test_short_secrets_are_found_among_many_ordinary_runs(spark):
    import random

    rnd = random.Random(5)
    base62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = ["there", "notion", "error", "Then", "entered", "rest", "index", "page", "2024", "v2", "getValue", "news", "user"]
    path = lambda: rnd.choice("-_/").join(rnd.choices(words, k=6))
    rows = [(i, " ".join(f"{rnd.choice(words)} {path()} {rnd.choice(words)}" for _ in range(20))) for i in range(400)]
    secrets = {1000 + i: "".join(rnd.choices(base62[:26] + "234567" if i % 2 else base62, k=n)) for i, n in enumerate([20, 20, 24, 24, 32, 32, 40, 40] * 10)}
    rows += [(i, f"see the {s} here") for i, s in secrets.items()]  # 1 % of the runs
    got = {r.doc_id: r.n_random for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n in (20, 24, 32, 40):
        assert sum(got[i] for i, s in secrets.items() if len(s) == n) >= 18, n
    assert sum(got[i] for i in range(400)) <= 2


def test_tokens_in_paths_that_fit_no_alphabet_are_found(spark):
    import random

    rnd = random.Random(7)
    base62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = [(i, " ".join(rnd.choices(["there", "com", "api", "org", "my", "hooks", "v1", "entered", "rest"], k=200))) for i in range(100)]
    tokens = ["".join(rnd.choices(base62, k=32)) for _ in range(40)] + ["".join(rnd.choices(base62 + "-_", k=40)) for _ in range(20)]
    rows += [(1000 + i, f"at com/api_v1/{s}/my-org there") for i, s in enumerate(tokens)]
    got = {r.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = 0
    for i, s in enumerate(tokens):
        spans = [[int(x) for x in span.split(":")[1:]] for span in got[1000 + i].split(",") if span]
        found += any(a <= 14 and 14 + len(s) <= b for a, b in spans)
    assert found >= 55
    assert not any(got[i] for i in range(100))


# -- 5, 6: classifiers --------------------------------------------------------


def test_held_out_accuracy(docs, labels, spark):
    from pyspark.sql import functions as F

    from quarry.llm.common import documents
    from quarry.sources.tables import read_table

    sf = "/root/testdata/sf0.01"
    docs, labels = documents(spark, sf), read_table(spark, sf, "labels")
    quality = quality_embed.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in quality) / len(quality) > 0.9
    toxic = toxicity.classify(docs, labels).join(labels, "doc_id")
    wrong = toxic.filter((F.col("predicted") == 1) & (F.col("toxic") == 0)).count()
    right = toxic.filter((F.col("predicted") == 1) & (F.col("toxic") == 1) & F.col("held_out")).count()
    assert wrong == 0 and right >= 8
    remainder = {r.doc_id: r.held_out for r in toxicity.classify(docs, labels).select("doc_id", "held_out").collect()}
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in remainder.items())


def test_counterfactual_penalty_clears_identity_terms():
    base = ["you are an idiot", "what an idiot", "such an idiot today", "nice day today", "good work today", "fine food here"] * 12
    group = ["the women idiot spoke"] * 10 + ["the women spoke"] * 2 + ["the men spoke"] * 12
    texts = base + group
    y = np.array([int("idiot" in t) for t in texts])
    # a spurious signal: women is toxic more often than men
    features = [np.unique(hash_words(pa.array(t.split()))) for t in texts]
    women = hash_words(pa.array(["women"]))[0]

    def weight(strength):
        model = toxicity.train(y, features, strength)
        at = np.flatnonzero(model.words == women)
        return float(model.weights[at[0]]) if len(at) else 0.0

    assert abs(weight(10.0)) <= abs(weight(0.0))
    assert abs(weight(10.0)) < 0.2


def sampled_words(n, least, most, vocabulary):
    """y and the words of ``n`` texts; frequent words are the first ones, and one word tells the label."""
    rng = np.random.default_rng(5)
    words = rng.permutation(np.arange(1, vocabulary + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    y = (np.arange(n) % 3 == 0).astype(np.int32)
    drawn = [np.unique((vocabulary * rng.random(k) ** 3).astype(int)) for k in rng.integers(least, most, n)]
    return y, [words[np.append(d[d != 7], np.full(t, 7))] for d, t in zip(drawn, y)]


def test_toxicity_fit_holds_few_bytes_a_pair():
    y, texts = sampled_words(1500, 300, 600, 20_000)
    tracemalloc.start()
    model = toxicity.train(y, texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.words)
    # the driver has the rest of the memory: 8 bytes a pair are the input
    assert most < 40 * sum(map(len, texts))


@pytest.mark.parametrize("block", [1, 50, 1 << 20])
def test_toxicity_sums_by_block_are_those_of_one_pass(block, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    _, texts = sampled_words(60, 0, 40, 90)
    lens = np.array([len(t) for t in texts])
    words, pairs = toxicity._learned(np.concatenate(texts), lens)
    every, word, df = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
    keep = df[word] >= toxicity.LEAST_TEXTS
    text, word = np.repeat(np.arange(60), lens)[keep], np.searchsorted(words, every[word[keep]])
    assert 0 < len(words) < len(every)
    assert words.tolist() == every[df >= toxicity.LEAST_TEXTS].tolist()
    of_word, of_text = np.random.default_rng(1).random((2, 100))
    assert pairs.by_text(of_word).tolist() == np.bincount(text, of_word[word], minlength=60).tolist()
    assert pairs.by_word(of_text).tolist() == np.bincount(word, of_text[text], minlength=len(words)).tolist()
    assert pairs.text_of(np.arange(len(text))).tolist() == text.tolist()
    odd = np.where(np.arange(len(words)) % 2, np.arange(len(words)) // 2, -1)
    fewer, at = pairs.only(odd, len(words) // 2), odd[word] >= 0
    assert fewer.by_word(of_text).tolist() == np.bincount(odd[word[at]], of_text[text[at]], minlength=len(words) // 2).tolist()


# -- 4: decontamination --------------------------------------------------------


def test_block_max_bounds_lose_nothing(texts, benchmark):
    rows = [(r.item_id, r.text) for r in benchmark.collect()]
    items = decontaminate.items_of(rows)
    df = Counter(w for i in items for w in set(i.words.tolist()))
    indexes = decontaminate.build(items, df, len(items), sum(len(i.words) for i in items) / len(items))
    batch = pa.array([t or "" for t in texts.values()])
    w = lexical_words_of(batch)
    vocab = hash_words(w.vocab)
    for index in indexes:
        number = np.minimum(np.searchsorted(index.terms, vocab), len(index.terms) - 1)
        term = np.where(index.terms[number] == vocab, number, -1)[w.idx]
        got = {(d, a, i) for d, a, _, i, _ in decontaminate.retrieve(index, term, w.starts, w.lens, 0.5)}
        want = set()
        weights = [{int(t): index.block_weights[b][k] for k, t in enumerate(own)} for b, own in enumerate(index.block_terms)]
        for d, (start, n) in enumerate(zip(w.starts.tolist(), w.lens.tolist())):
            for j in range(n // index.span + 1):
                a = start + j * index.span
                present = set(term[a : min(a + 2 * index.span, start + n)].tolist())
                for b, own in enumerate(weights):
                    score = sum((own[t] for t in present if t in own), np.zeros(decontaminate.BLOCK))
                    want |= {(d, a, b * decontaminate.BLOCK + i) for i in np.flatnonzero(score >= 0.5 - 1e-9).tolist() if b * decontaminate.BLOCK + i < len(index.items)}
        assert got == want


def test_items_are_found_in_every_slice(docs, texts, benchmark, spark, monkeypatch):
    rows = [(r.item_id, r.text) for r in benchmark.collect()]
    want = {(d, i) for d, t in texts.items() for i, item in rows if item in (t or "")}
    assert want
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_matches(docs, benchmark).collect()} == want
    indexes = list(decontaminate.index_slices(benchmark, slice_bytes=1500))
    assert len(indexes) > 2 and sum(len(i.items) for part in indexes for i in part) == len(rows)
    batch = pa.array(list(texts.values()))
    ids = list(texts)
    assert {(ids[d], i) for part in indexes for d, i in decontaminate.matches(batch, part)} == want


# -- 7: repeated passages ------------------------------------------------------


def brute_repeats(rows):
    first = {}
    for d, text in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            first[key] = min(first.get(key, d), d)
    out = Counter()
    for d, text in rows:
        w = WORD.findall(text or "")
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone |= set(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("group", [2048, 1])
def test_repeated_passages(spark, texts, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    passage = " ".join(f"p{i}" for i in range(60))
    long = " ".join(f"r{i % 7}" for i in range(300))
    rows = [(d, t) for d, t in texts.items()][:80]
    rows += [(1000 + i, f"own{i} start {passage} own{i} end") for i in range(12)]
    rows += [(2000, passage), (2001, passage), (2002, long), (2003, long + " tail"), (2003, "x " + long), (2004, None)]
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_repeats(rows)


# -- 8: fingerprints -----------------------------------------------------------


def test_edited_texts_and_neighbours(docs, texts):
    got = {r.doc_id: r for r in spot_sigs.fingerprint_table(docs).collect()}
    order = sorted(texts, reverse=True)
    for i, d in enumerate(order):
        text, after = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = spot_sigs.fingerprints(pa.array([text, edited, after]))
        assert got[d].fingerprint == spot_sigs.as_string(a) and got[d].edited_fingerprint == spot_sigs.as_string(b)
        assert math.isclose(got[d].near_edited, spot_sigs.likeness(a, b)) and math.isclose(got[d].near_next, spot_sigs.likeness(a, c))


def test_similar_fingerprints(spark):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 32, rng.integers(5, 60), dtype=np.uint64).astype(np.uint32)) for _ in range(60)]
    for s in list(sets[:30]):
        sets.append(np.unique(np.concatenate([s[1:], rng.integers(0, 1 << 32, 1, dtype=np.uint64).astype(np.uint32)])))
        sets.append(s[: max(1, int(len(s) * 0.85))])
    strings = [spot_sigs.as_string(s) for s in sets]
    table = spark.createDataFrame([(s,) for s in [*strings, *strings[:5], ""]], "fingerprint string")
    got = {(r.a, r.b): r.similarity for r in spot_sigs.near_pairs(table, 0.8).collect()}
    want = {}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if strings[i] != strings[j] and spot_sigs.likeness(a, b) >= 0.8:
                want[min(strings[i], strings[j]), max(strings[i], strings[j])] = spot_sigs.likeness(a, b)
    assert got == pytest.approx(want) and len(want) > 20


# -- 9: near duplicates --------------------------------------------------------


def test_samples_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(2000)]
    base = [words[i] for i in rng.integers(0, 2000, 4000)]
    edit = list(base)
    for i in rng.integers(0, 4000, 120):
        edit[i] = "new"
    idf = near_dup.Idf(np.zeros(0, np.uint64), np.zeros(0), 3.0)
    s = near_dup.weighted_sets(pa.array([" ".join(base), " ".join(edit)]), idf)
    one = [(s.shingles[a : a + n], s.weights[a : a + n]) for a, n in zip(s.starts, s.lens)]
    sig = near_dup.samples(s)
    assert abs((sig[0] == sig[1]).mean() - near_dup.weighted_jaccard(*one)) < 0.16


def test_samples_are_those_of_each_shingle_drawn_alone():
    """Texts of unlike lengths share a matrix; the samples are those of a plain loop over the shingles."""
    rng = np.random.default_rng(11)
    lens = [0, 3, 700, 1, 5, 40, 6, 0, 4, 90, 2, 260]
    texts = pa.array([" ".join(f"w{i}" for i in rng.integers(0, 300, n)) for n in lens])
    s = near_dup.weighted_sets(texts, near_dup.Idf(np.zeros(0, np.uint64), np.zeros(0), 3.0))
    got = near_dup.samples(s)
    u = np.uint64
    for row, (a, n) in enumerate(zip(s.starts, s.lens, strict=True)):
        code, log_s = s.shingles[a : a + n], np.log(s.weights[a : a + n]).astype(np.float32)
        for k in range(near_dup.SAMPLES if n else 0):
            h = code * near_dup.SEEDS[2 * k]
            h = (h ^ (h >> u(29))) * near_dup.SEEDS[2 * k + 1]
            r, log_c = near_dup.GAMMA_R[h >> u(48)], near_dup.LOG_C[(h >> u(32)) & u(0xFFFF)]
            beta = ((h >> u(16)) & u(0xFFFF)).astype(np.float32) / np.float32(65536)
            t = np.floor(log_s / r + beta)
            least = np.argmin(log_c - r * (t - beta + 1))
            assert got[row, k] == near_dup.mix(code[least : least + 1] + t[least : least + 1].astype(np.int64).astype(u) * near_dup.SEEDS[0]).astype(np.uint32)[0]
        assert n or not got[row].any()


def test_the_word_pattern_reads_distinct_parts_only(monkeypatch):
    """Cutting by the pattern is the dear part of a word; texts of the same words need it once."""
    seen, cut = [], pc.split_pattern_regex
    monkeypatch.setattr(common.pc, "split_pattern_regex", lambda a, p: seen.extend(a.to_pylist()) or cut(a, p))
    texts = ["The  café, plain\x00WORDS_1 — Ünder\u200bscore", "plain words_1 a—b 日本語、です", "", None, "——", "\u212a K k İx ΣΑΣ e\u0301"] * 50
    w = lexical_words_of(pa.array(["left out", *texts]).slice(1))
    words = [w.vocab[i].as_py() for i in w.idx]
    lower = [pc.utf8_lower(pa.array([t or ""]))[0].as_py() for t in texts]
    each = [[x for x in cut(pa.array([t]), r"[^\pL\pN\pM_]+")[0].as_py() if x] for t in lower]
    assert words == [x for t in each for x in t]
    assert w.lens.tolist() == [len(t) for t in each] and w.starts.tolist() == np.cumsum([0, *w.lens])[:-1].tolist()
    assert w.vocab.to_pylist() == list(dict.fromkeys(words))  # numbered as they first occur
    assert len(seen) == len(set(seen)) <= 10
    for none in (pa.array([], pa.string()), pa.array(["", None, " \t"])):
        w = lexical_words_of(none)
        assert len(w.vocab) == len(w.idx) == w.lens.sum() == 0 and len(w.lens) == len(none)


def test_near_duplicate_classes(spark):
    rng = np.random.default_rng(2)
    word = lambda: f"w{rng.integers(0, 5000)}"
    boiler = " ".join(word() for _ in range(40))
    rows, kin = [], {}
    for k in range(12):
        base = [word() for _ in range(int(rng.integers(60, 200)))]
        for c in range(int(rng.integers(1, 40))):
            text = list(base)
            if c:
                text[int(rng.integers(0, len(text)))] = f"edit{c}"
            d = len(rows)
            rows.append((d, " ".join(text)))
            kin.setdefault(k, []).append(d)
    rows += [(len(rows) + i, f"{boiler} " + " ".join(word() for _ in range(60))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()}
    for members in kin.values():
        assert {got[d] for d in members} == {min(members)}
    alone = [d for d, _ in rows if all(d not in m for m in kin.values())]
    assert all(got[d] == d for d in alone)


def test_every_pair_of_a_large_bucket_meets(spark, monkeypatch):
    """400 texts filled from one template, about 0.7 alike, but in pairs just
    over 0.8: hashed groups of their large buckets miss some of the pairs."""
    rng = np.random.default_rng(9)
    word = lambda: f"w{rng.integers(0, 100_000)}"
    template = [word() for _ in range(330)]
    texts = []
    for _ in range(200):
        both = template + [word() for _ in range(12)]
        texts += [both + [word() for _ in range(11)] for _ in range(2)]
    texts += [[word() for _ in range(5)] for _ in range(3000)]
    df = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    monkeypatch.setattr(near_dup, "TILE", 64)
    monkeypatch.setattr(near_dup, "SMALL", 4)
    monkeypatch.setattr(near_dup, "GROUP", 2)
    docs = df.select("doc_id", "text")
    sets = near_dup.weighted_sets(pa.array([" ".join(t) for t in texts]), near_dup.document_frequencies(docs).value)
    sig, all_sets = near_dup.samples(sets), [(sets.shingles[a : a + n], sets.weights[a : a + n]) for a, n in zip(sets.starts, sets.lens)]
    bands = sig.reshape(len(texts), near_dup.BANDS, near_dup.ROWS)
    root = list(range(len(texts)))
    n_linked = n_met = 0
    for i in range(400):  # the others have no word in common
        for j in range(i):
            if not (bands[i] == bands[j]).all(1).any() or (sig[i] == sig[j]).sum() < near_dup.LEAST_AGREEMENT:
                continue
            n_met += 1
            if near_dup.weighted_jaccard(all_sets[i], all_sets[j]) >= near_dup.SIMILARITY:
                n_linked += 1
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    assert 100 <= n_linked < n_met / 10
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()}
    assert got == dict(enumerate(root))



def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 200), (7, 7)]
    scratch = Scratch(spark)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), scratch, "c").collect()}
    scratch.delete()
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


# -- 10: language model --------------------------------------------------------


def test_base_scores(docs, texts):
    got = {r.doc_id: r for r in backoff_lm.score(docs).collect()}
    tokens = {d: [*(t or "").encode().lower().split(), None] for d, t in texts.items()}
    counts = Counter(w for d, own in tokens.items() if zlib.crc32(str(d).encode()) % 10 for w in own)
    n, v = sum(counts.values()), len(counts)
    for d, own in tokens.items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert math.isclose(got[d].base_score, base, rel_tol=1e-9)
        assert (got[d].n_tokens, got[d].n_known, got[d].train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 10 == 0)


def test_words_of_matches_the_contract():
    text = "a\x0bb\x0cc\x1cd\x85e f g \r\n h\tI"
    w = words_of(pa.array([text, None, ""]))
    assert [w.vocab[i].as_py() for i in w.idx] == WORD.findall(text) and w.lens.tolist() == [len(WORD.findall(text)), 0, 0]


def test_many_texts_without_an_id_meet_no_other_text(spark):
    """300 different texts without id share one passage with a text of id 1."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"first {passage} last")] + [(None, f"own{i} {passage} tail{i} " + " ".join(f"x{i}y{j}" for j in range(20))) for i in range(300)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed) for r in got) == Counter({(1, 62, 0): 1, (None, 82, 60): 300})
    assert len({r.kept_sha256 for r in got}) == 301


def test_every_packed_file_has_a_task(spark, docs, bpe_path):
    scratch = Scratch(spark)
    folder = scratch.path("ids")
    manifest = scratch.store(token_pack.write_packed(docs, folder, bpe_path, 1, shards=5), "manifest")
    tasks = token_pack.read_packed(manifest, folder).withColumn("task", F.spark_partition_id()).select("task", "shard").distinct().collect()
    scratch.delete()
    assert len({r.shard for r in tasks}) > 1 and len({r.task for r in tasks}) == len({r.shard for r in tasks}) == len(tasks)
