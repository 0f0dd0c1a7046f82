"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (ann, conversation_trie, exact_dedup, grid_join, html_text, langid, minhash, packing, suffix_dedup, token_output, unigram, url_filter,
               whitening)
from .common import table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, sf_dir, "pages"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search_embeddings(table(spark, sf_dir, "embeddings"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.written_order(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.encode_documents(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_nearest_neighbours, op3_suffix_dedup, op4_token_output, op5_html_text, op6_embedding_dedup,
    op7_sentencepiece, op8_language_id, op9_minhash, op10_packing, op11_prefix_trie, op12_whitening, op13_exact_dedup)}

ORACLES: dict[str, str] = {"op1_url_filter": url_filter.judge_sql(), "op11_prefix_trie": conversation_trie.trie_sql(),
                           "op13_exact_dedup": exact_dedup.duplicates_sql()}
