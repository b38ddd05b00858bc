"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gam, lines, mixing, packing, pages, periodic, resampling, rules, secretscan, sharding, simhash, suffixes
from . import vectors
from .common import table


def op1_pivot_distance_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vectors.search(rows, rows.where("vec_id % 50 = 0"), 5)


def op2_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 16)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove(table(spark, sf_dir, "documents")).drop("spans")


def op4_additive_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's remaining text and, in numbers, its lines, dropped copies and near lines, and links."""
    thinned = lines.thin(table(spark, sf_dir, "documents"))
    return thinned.select("doc_id", "text", *(F.col(c).alias(c.removeprefix("_llm_")) for c in lines.ADDED))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return rules.judge(table(spark, sf_dir, "documents"), trusted)


def op10_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents after the rule that turns the tail of every tenth one, by checksum, into copies."""
    return periodic.digest(periodic.collapse(periodic.with_repeats(table(spark, sf_dir, "documents"))))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digest(secretscan.scan(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pivot_distance_search,
        op2_hash_tree_sharding,
        op3_suffix_dedup,
        op4_additive_quality_classifier,
        op5_best_fit_packing,
        op6_mixing,
        op7_simhash_near_dedup,
        op8_line_dedup,
        op9_quality_rules,
        op10_template_extraction,
        op11_importance_resampling,
        op12_periodic_runs,
        op13_secret_scan,
    )
}
