"""Corpus pipeline: raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``documents``.

toxicity        texts that the classifier scores as toxic go
near_dedup      one row of each class of near duplicates stays
decontaminate   texts in which a benchmark item stands go
secrets         secrets in the texts are replaced by a mark
encode          texts become SentencePiece ids, verified against the reference

Defined results: a null or empty text is scored like any other, is nobody's
copy, holds no item and no secret, and encodes to no ids.  Rows of equal id are judged apart; of rows that share id and words one
stays, and unlike texts under one id, or without id, all stay.  Of equal or
near texts the row of the least id stays, a null id counting as the greatest.
Very long texts are worked on whole.  Columns other than ``doc_id``, ``text``
and ``n_chars`` pass through unread, whatever their names; an empty table
passes as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, near_dup, piece_codec, secret_scan, toxicity
from quarry.llm.catalog import vocabulary
from quarry.llm.common import Scratch, documents
from quarry.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_codec.encode(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", redact_secrets),
    ("encode", encode),
]

#: SQL cannot express the trained, sampled and tokenized stages; the tests
#: compare the pipeline with brute-force versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: doc_id, n_tokens, token_ids, parity.

    The table between two stages is deleted once the later one is written; the
    last one is read by the returned DataFrame and stays in the scratch folder."""
    scratch = Scratch(spark)
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES[:-1]):
        docs = scratch.store(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.delete(f"{k - 1}-{STAGES[k - 1][0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
