"""The corpus pipeline: documents to token ids in five stages, each an operator of ``trackscene.llm``.

Every stage but the last returns the columns of ``documents``; ``run`` writes
what a stage keeps to the shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackscene.llm import bpe, exact, mix, ngram, toxicity
from trackscene.llm.common import stash

RANKS = "byte_bpe_50k.tiktoken"

#: A learned score, similarity links and token ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go."""
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by the weights of their sources."""
    return mix.mix_sources(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of ids and decoded text of every row."""
    import public_tokenizers
    return bpe.digests(docs, public_tokenizers.path(RANKS), with_ids=True)


STAGES = [("toxicity", toxic), ("exact_dedup", exact_copies), ("ngram_jaccard", near_copies), ("mix_sources", mixed), ("byte_bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
