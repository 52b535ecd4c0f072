"""The queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.llm import (
    ann,
    divergence,
    jaccard,
    metric,
    mixing,
    packing,
    pii,
    quality,
    sharding,
    suffix,
    trie,
    urls,
    whitening,
)
from reelspark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


def op2_multiprobe_hashing(spark: SparkSession, folder: str) -> DataFrame:
    vectors = ann.usable(table(spark, folder, "embeddings"))
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"))


def op3_weak_supervision_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pii.find(docs, pii.fit(docs))


def op4_token_group_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_copies(table(spark, folder, "documents"))


def op5_elias_fano_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.score(table(spark, folder, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffix.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rules = quality.fit(docs, table(spark, folder, "labels"))
    out = quality.judge(docs, rules)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_large_item_matching(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pieces_of(table(spark, folder, "documents"), packing.rank_file())
    return packing.pack(pieces)


def op9_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), urls.rule_table(spark, urls.RULES))


def op10_pivotal_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op11_divergence_quadtree(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


def op12_metric_range_join(spark: SparkSession, folder: str) -> DataFrame:
    return metric.near_copies(table(spark, folder, "embeddings"))


def op13_refined_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def registered() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_extendible_sharding,
        op2_multiprobe_hashing,
        op3_weak_supervision_pii,
        op4_token_group_jaccard,
        op5_elias_fano_trie,
        op6_suffix_array_dedup,
        op7_decision_list,
        op8_large_item_matching,
        op9_url_rules,
        op10_pivotal_mixing,
        op11_divergence_quadtree,
        op12_metric_range_join,
        op13_refined_whitening,
    )}
