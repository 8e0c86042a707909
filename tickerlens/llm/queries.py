"""The registered queries of this subpackage: name -> (query, oracle SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlens.llm import (
    fill_in_middle, licence_scan, line_templates, minmax_dedup, oracles, packing, quality_rules, secret_scan, substring_dedup, temperature_mixing, toxicity, url_filter,
    vector_range_join, whitening,
)
from tickerlens.llm.common import load


def _sha256(column: str):
    return F.sha2(F.coalesce(F.col(column), F.lit("")), 256)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeated_windows(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", _sha256("kept_text").alias("kept_sha256"))


def op2_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_templates.drop_recurring_lines(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", _sha256("kept_text").alias("kept_sha256"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(load(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(load(spark, sf_dir, "documents")).drop("row_hash")


def op5_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(load(spark, sf_dir, "documents"), n=3, share=(85, 100), rows=5)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temperature_mixing.mixed_order(load(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_corpus(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(load(spark, sf_dir, "pages"), url_filter.rules_frame(spark))


def op10_vector_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_range_join.link_vectors(load(spark, sf_dir, "embeddings"))


def op11_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.scan_licences(load(spark, sf_dir, "documents")).drop("passages")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(load(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", _sha256("output").alias("output_sha256"), F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_substring_dedup": (op1_substring_dedup, oracles.SUBSTRING_DEDUP),
    "op2_line_templates": (op2_line_templates, None),
    "op3_secret_scan": (op3_secret_scan, None),
    "op4_quality_rules": (op4_quality_rules, None),
    "op5_minmax_dedup": (op5_minmax_dedup, oracles.NEAR_DUPLICATES),
    "op6_best_fit_packing": (op6_best_fit_packing, None),
    "op7_temperature_mixing": (op7_temperature_mixing, None),
    "op8_toxicity": (op8_toxicity, None),
    "op9_url_filter": (op9_url_filter, oracles.URL_FILTER),
    "op10_vector_range_join": (op10_vector_range_join, oracles.LINKED_VECTORS),
    "op11_licence_scan": (op11_licence_scan, oracles.LICENCE_SCAN),
    "op12_fill_in_middle": (op12_fill_in_middle, oracles.FILL_IN_MIDDLE),
    "op13_whitening": (op13_whitening, None),
}
