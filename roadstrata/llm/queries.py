"""The operators of this package as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadstrata.llm import (
    bpe,
    divergence,
    lang_id,
    licenses,
    line_dedup,
    manifest,
    mixing,
    sharding,
    simhash,
    token_counts,
    token_files,
    vectors,
)
from roadstrata.llm.common import documents, embeddings

Query = Callable[[SparkSession, str], DataFrame]


def op1_graph_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(embeddings(spark, sf_dir))


def op2_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_slots(documents(spark, sf_dir))


def op3_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest_vectors(embeddings(spark, sf_dir))


def op4_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(documents(spark, sf_dir))


def op5_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(documents(spark, sf_dir))


def op6_rank_merging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_report(documents(spark, sf_dir))


def op7_word_shuffle_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_report(documents(spark, sf_dir))


def op8_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


def op10_marginal_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.language_report(documents(spark, sf_dir))


def op11_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_report(documents(spark, sf_dir))


def op12_skyband_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir))


def op13_postorder_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest_report(documents(spark, sf_dir)).drop("tampered", "log_place")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_graph_near_vectors,
        op2_jump_shards,
        op3_graph_search,
        op4_gray_simhash,
        op5_signature_rules,
        op6_rank_merging,
        op7_word_shuffle_bpe,
        op8_pivotal_mix,
        op9_line_runs,
        op10_marginal_unigrams,
        op11_rans_files,
        op12_skyband_divergence,
        op13_postorder_manifest,
    )
}
