"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing
column names: every operator and stage has its stated result for them."""

from collections import Counter

import pytest

import corpus_pipeline
from quarry.llm import backoff_lm, decontaminate, near_dup, piece_codec, quality_embed, secret_scan, spot_sigs, suffix_dedup, token_pack, toxicity


@pytest.fixture(scope="module")
def ids(odd):
    return Counter(r.doc_id for r in odd.select("doc_id").collect())


@pytest.fixture(scope="module")
def no_items(spark):
    return spark.createDataFrame([(1, None), (None, ""), (2, "?!")], "item_id long, text string")


def by_row(spark, df):
    rows = df.collect()
    return Counter(r.doc_id for r in rows), rows


CASES = {
    "piece_codec": lambda d, lab, bpe, piece: piece_codec.round_trip(d, piece),
    "secret_scan": lambda d, lab, bpe, piece: secret_scan.scan(d),
    "token_pack": lambda d, lab, bpe, piece: token_pack.pack_documents(d, bpe),
    "toxicity": lambda d, lab, bpe, piece: toxicity.classify(d, lab),
    "quality": lambda d, lab, bpe, piece: quality_embed.classify(d, lab),
    "suffix_dedup": lambda d, lab, bpe, piece: suffix_dedup.remove_repeats(d),
    "spot_sigs": lambda d, lab, bpe, piece: spot_sigs.fingerprint_table(d),
    "near_dup": lambda d, lab, bpe, piece: near_dup.near_duplicates(d),
    "backoff_lm": lambda d, lab, bpe, piece: backoff_lm.score(d),
}


@pytest.mark.parametrize("name", CASES)
def test_every_row_has_its_row(spark, odd, odd_labels, ids, bpe_path, piece_path, name):
    got, rows = by_row(spark, CASES[name](odd, odd_labels, bpe_path, piece_path))
    assert got == ids
    if name == "token_pack":
        assert [r.start for r in sorted(rows, key=lambda r: r.start)][0] == 0
        assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 7)} == {1}
    if name == "secret_scan":
        assert [r.spans for r in rows if r.doc_id == 8] == ["assign:0:33,hex:9:33"]
        assert {r.spans for r in rows if r.doc_id != 8} == {""}
    if name == "suffix_dedup":
        by_id = {r.doc_id: r for r in rows}
        assert by_id[3].n_removed == 0 and by_id[4].n_removed == by_id[4].n_words - 1
        assert by_id[6].n_removed == 0 and by_id[1].n_words == by_id[7].n_words == 0
    if name == "near_dup":
        assert {(r.doc_id, r.class_id) for r in rows if r.doc_id in (1, 2, 7)} == {(1, 1), (2, 2), (7, 7)}
        assert {r.class_id for r in rows if r.doc_id in (3, 4)} == {3}
        assert {r.class_id for r in rows if r.doc_id == 6} == {5, 6}
    if name == "spot_sigs":
        assert {r.fingerprint for r in rows if r.doc_id in (1, 2, 7)} == {""}
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    if name == "backoff_lm":
        assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 7)} == {1}
    if name in ("toxicity", "quality"):
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    if name == "piece_codec":
        assert all(r.parity and r.round_trip for r in rows)


@pytest.mark.parametrize("name", CASES)
def test_empty_tables(spark, empty, no_labels, bpe_path, piece_path, name):
    assert CASES[name](empty, no_labels, bpe_path, piece_path).collect() == []


def test_without_labels_all_scores_are_one_half(docs, no_labels):
    assert {r.score for r in toxicity.classify(docs, no_labels).collect()} == {0.5}
    assert {r.score for r in quality_embed.classify(docs, no_labels).collect()} == {0.5}


def test_decontaminate_edges(spark, odd, empty, benchmark, no_items):
    assert decontaminate.find_matches(odd, benchmark).collect() == []
    assert decontaminate.find_matches(odd, no_items).collect() == []
    assert decontaminate.find_matches(empty, benchmark).collect() == []
    item = spark.createDataFrame([(9, "the same short text"), (9, "the same short text")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.find_matches(odd, item).collect()) == [(5, 9), (6, 9)]
    kept = decontaminate.drop_contaminated(odd, item)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
    assert decontaminate.drop_contaminated(odd, no_items).count() == odd.count()


def test_near_duplicate_filter_keeps_one_row_of_each_class(odd, empty):
    kept = near_dup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    rows = [(r.doc_id, (r.text or "")[:12]) for r in kept.collect()]
    assert Counter(d for d, _ in rows) == Counter({None: 2, 1: 2, 2: 1, 3: 1, 5: 1, 6: 1, 7: 1, 8: 1})
    assert (6, "another text") in rows
    assert near_dup.drop_near_duplicates(empty).collect() == []


def test_near_duplicate_filter_keeps_unlike_texts_of_one_id(spark):
    rows = [(None, "one text of a row that has no id"), (None, "quite other words stand in this second row"), (None, "a third row tells of ships at sea")]
    rows += [(6, "six is the id of this first text"), (6, "under that number comes something else again"), (6, "under that number comes something else again")]
    rows += [(None, "a third row tells of ships at sea"), (9, "six is the id of this first text")]
    kept = near_dup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(set(rows) - {(9, "six is the id of this first text")})


def test_redaction(odd, empty):
    rows = {r.doc_id: r for r in secret_scan.redact(odd).collect()}
    assert rows[8].text == '[secret]" \U0001f600 é' and rows[8].n_chars == 13
    assert rows[2].text is None and rows[3].text.startswith("word0")
    assert secret_scan.redact(empty).collect() == []


def test_stages_keep_the_columns(spark, odd, empty, tmp_path, monkeypatch, odd_labels, benchmark):
    tables = {"labels": odd_labels, "benchmark": benchmark}
    monkeypatch.setattr(corpus_pipeline, "read_table", lambda s, d, name: tables[name])
    for name, stage in corpus_pipeline.STAGES:
        for table in (odd, empty):
            out = stage(spark, table, str(tmp_path))
            if name != "encode":
                assert out.columns == table.columns and out.schema.simpleString() == table.schema.simpleString()
            assert out.count() <= table.count()
