"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_dir
from ..tables import load
from .bpe import round_trip_digests
from .decontaminate import find_contamination
from .language_id import identify_languages
from .lm_scoring import score_texts
from .merkle import tamper_report
from .oracle import ORACLE  # noqa: F401
from .pii import pii_report
from .quality_classifier import score_quality
from .quality_rules import apply_rules
from .sharding import assign_shards
from .simhash import near_duplicates
from .spelling import spelling_variants
from .token_counts import count_tokens
from .token_store import read_token_digests, write_token_store

N_SHARDS = 40


def tokenizer(name: str) -> str:
    """Path of a tokenizer file of the installed package."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    out = apply_rules(spark, load(spark, sf, "documents"), load(spark, sf, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_token_store(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "op2")
    write_token_store(spark, load(spark, sf, "documents"), tokenizer("word_bpe_49k.json"), path, end_id=1, rule="drop")
    return read_token_digests(spark, path)


def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return find_contamination(load(spark, sf, "documents"), load(spark, sf, "benchmark")).drop("version")


def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return round_trip_digests(spark, load(spark, sf, "documents"), tokenizer("byte_bpe_50k.json"))


def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(spark, load(spark, sf, "documents"), shingle=3, max_bits=2)


def op6_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return assign_shards(load(spark, sf, "documents"), N_SHARDS)


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return identify_languages(load(spark, sf, "documents"))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(spark, load(spark, sf, "documents"), tokenizer("byte_bpe_50k.json"), limit=512, rule="keep")


def op9_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii_report(load(spark, sf, "documents"))


def op10_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return score_quality(load(spark, sf, "documents"), load(spark, sf, "labels"))


def op11_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(spark, load(spark, sf, "documents"))


def op12_merkle(spark: SparkSession, sf: str) -> DataFrame:
    return tamper_report(spark, load(spark, sf, "documents"), scratch_dir(spark, "op12"))


def op13_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return score_texts(spark, load(spark, sf, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_store": op2_token_store,
    "op3_decontaminate": op3_decontaminate,
    "op4_bpe": op4_bpe,
    "op5_simhash": op5_simhash,
    "op6_sharding": op6_sharding,
    "op7_language_id": op7_language_id,
    "op8_token_counts": op8_token_counts,
    "op9_pii": op9_pii,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_spelling": op11_spelling,
    "op12_merkle": op12_merkle,
    "op13_lm_scoring": op13_lm_scoring,
}
