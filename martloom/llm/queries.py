"""The dealt operators and the pipeline as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import (
    decontamination, exact_dedup, language, mixing, phrases, prefix_trie, quality, simhash, site_style, token_counts,
    token_files, toxicity, url_filter,
)

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = quality.fit(docs, _table(spark, folder, "labels"))
    return quality.score_quality(docs, model).select(
        "row.doc_id", (F.crc32(F.col("row.doc_id").cast("string")) % quality.FOLDS == 0).alias("held_out"), "judged.*")


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.schedule(_table(spark, folder, "documents"), ["doc_id"]).select("row.doc_id", "mix.*")


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    files = token_counts.write_flat_files(_table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))
    return token_counts.with_doc_ids(token_counts.count_tokens(files), files)


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return site_style.extract(_table(spark, folder, "pages"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    parts = token_files.write_token_files(_table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))
    return token_files.read_token_files(parts)


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, _table(spark, folder, "labels")))


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"))


def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return language.predict(docs, language.fit(docs))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality, op2_mixing, op3_token_counts, op4_decontamination, op5_html_text, op6_simhash, op7_token_files,
        op8_url_filter, op9_exact_dedup, op10_toxicity, op11_phrases, op12_prefix_trie,
        op13_language, pipeline)
}
ORACLES = {"op8_url_filter": url_filter.oracle(), "op9_exact_dedup": exact_dedup.ORACLE,
           "op11_phrases": phrases.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE}
