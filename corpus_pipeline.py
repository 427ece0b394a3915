"""The corpus pipeline: five stages over `documents`, each written as Parquet
and read again before the next.

Language ID drops documents whose language cannot be determined, SimHash
near-dedup keeps one document of each group, decontamination drops documents
that share a window of words with a benchmark item, PII replaces personal data
by its kind, and BPE turns what is left into token ids, of which the last
stage returns counts and digests. Ids and other columns pass through; rows
without text, repeated rows and empty tables are handled as each operator
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import round_trip_digests
from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.language_id import keep_identified
from tidemark.llm.pii import redact
from tidemark.llm.queries import tokenizer
from tidemark.llm.simhash import keep_one_of_each
from tidemark.session import scratch_dir
from tidemark.tables import load


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(spark, docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = redact(docs)
    n_chars = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    return out.select(*[n_chars.alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip_digests(spark, docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("bpe", tokens),
]

#: Stages 1, 2, 4 and 5 (trained models, hashes, a tokenizer) have no SQL; the
#: pipeline is tested against its stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
