"""Registered queries of the numbered operators (and the pipeline's DuckDB twins).

Each query applies its operator, with production parameters, to the whole
tables and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import backoff_lm, conversation_repair, decontaminate, near_dup, piece_codec, quality_embed, secret_scan, sim_hash, spot_sigs, suffix_dedup, token_pack, toxicity, whitening
from quarry.llm.common import documents
from quarry.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file on this machine (installed on every executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every text, decoded again and verified."""
    return piece_codec.round_trip(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base patterns and random runs in every text."""
    return secret_scan.scan(documents(spark, sf_dir))


@query
def op3_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, with end id 1, through packed files and back."""
    return token_pack.pack_documents(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end_id=1)


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text."""
    return toxicity.classify(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


@query
def op6_quality_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text."""
    return quality_embed.classify(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item found in it."""
    return decontaminate.find_matches(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


@query
def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_dup.near_duplicates(documents(spark, sf_dir))


@query
def op8_spot_sigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    return spot_sigs.fingerprint_table(documents(spark, sf_dir))


@query
def op10_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log10 probability of every text."""
    return backoff_lm.score(documents(spark, sf_dir))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat a passage of an earlier one."""
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


@query
def op13_sim_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and class of every document."""
    return sim_hash.near_classes(documents(spark, sf_dir))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation."""
    return conversation_repair.repair(read_table(spark, sf_dir, "conversations"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened leading components of every embedding."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))
