"""The registered queries of the training-data operators, and DuckDB SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe_codec, embedding_join, html_content, language_id, merkle_manifest, minhash_join, packing, quality_rules, source_mix, suffix_dedup, token_alignment, token_counts, token_files
from .common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op2_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_epsilon_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op8_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(table(spark, sf_dir, "pages"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.taken(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle_manifest.audit(docs, merkle_manifest.tampered(docs))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_minhash_join,
        op3_epsilon_grid_join,
        op4_bpe_codec,
        op5_suffix_dedup,
        op6_best_fit_packing,
        op7_quality_rules,
        op8_html_content,
        op9_token_files,
        op10_language_id,
        op11_source_mix,
        op12_token_alignment,
        op13_merkle_manifest,
    )
}

ORACLE: dict[str, str] = {
    "op3_epsilon_grid_join": embedding_join.SQL,
    "op7_quality_rules": quality_rules.SQL,
    "op11_source_mix": source_mix.SQL,
    "op13_merkle_manifest": merkle_manifest.SQL,
}
