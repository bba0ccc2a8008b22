"""Registered queries of the training-data operators: name -> (Spark query, DuckDB SQL where SQL can express it)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import align, bpe, exact, html, minhash, mix, ngram, quality, substring, tokenio, toxicity, trie, warc

#: Vocabulary files that the queries use; operators take a path.
JSON_VOCABULARY, RANK_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"

QUERIES = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _over(name: str, table: str, fn, sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(_table(spark, sf_dir, table))
    if sql:
        ORACLE[name] = sql


_over("op1_mix_sources", "documents", mix.query, mix.ORACLE)
_over("op2_substring_dedup", "documents", substring.query)
_over("op3_exact_dedup", "documents", exact.query, exact.ORACLE)
_over("op4_token_output", "documents", lambda d: tokenio.query(d, vocabulary(JSON_VOCABULARY)))
_over("op6_byte_bpe", "documents", lambda d: bpe.query(d, vocabulary(RANK_VOCABULARY)))
_over("op7_quality_rules", "documents", quality.query, quality.ORACLE)
_over("op10_ngram_jaccard", "documents", ngram.query, ngram.ORACLE)
QUERIES["op5_toxicity"] = lambda spark, sf_dir: toxicity.query(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
_over("op8_html_extraction", "pages", html.query)
_over("op9_warc_audit", "pages", warc.query)
_over("op11_conversation_trie", "conversations", trie.query, trie.ORACLE)
_over("op12_minhash_dedup", "documents", minhash.query, minhash.ORACLE)
_over("op13_token_alignment", "documents", lambda d: align.query(d, vocabulary(JSON_VOCABULARY), vocabulary(PIECE_VOCABULARY)))
QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
