"""One query per operator over its whole table, with production parameters, and the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flatweave.llm import (ann, chat, fim, jaccard, kneser, language, leaks, mixing, neardup, packing, sharding,
                           substrings, trie)
from flatweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


def op2_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op3_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(table(spark, sf_dir, "conversations"))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser.perplexities(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op6_suffix_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(table(spark, sf_dir, "documents"))


def op7_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op8_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op11_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_language_id, op2_cross_polytope, op3_chat_snapshots,
                                    op4_kneser_ney, op5_mixing, op6_suffix_groups, op7_kd_shards, op8_pca_tiles, op9_packing,
                                    op10_signature_trees, op11_block_rotation, op12_prefix_trie,
                                    op13_benchmark_leaks)}


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_snapshots": chat.RENDERED_SQL, "op11_block_rotation": fim.DIGESTS_SQL,
            "op12_prefix_trie": trie.PREFIX_TRIE_SQL,
            "op13_benchmark_leaks": leaks.CONTAMINATION_SQL}
