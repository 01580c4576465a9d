"""The registered opN_ queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import (chat, decontaminate, html_layout, merkle, ngram_rtree, packing, pii, quality_net, quality_rules, setsketch, token_prefix, warc,
                         whitening)
from tagloom.llm.oracle import ORACLE_SQL
from tagloom.sources.tables import table


def op1_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_prefix.token_counts(table(spark, sf_dir, "documents"))


def op4_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract(table(spark, sf_dir, "pages"))


def op5_string_tiling_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


def op7_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_net.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


#: A conversation made of control strings, which every run formats beside the table's own.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op9_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    control = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                                    "conv_id long, turn long, role string, text string")
    return chat.round_trip(table(spark, sf_dir, "conversations").select(*columns).unionByName(control))


def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_merkle_butterfly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_count_vector_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_rtree.ngram_join(table(spark, sf_dir, "documents"))


def op13_cholesky_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_weak_supervision_pii": op1_weak_supervision_pii,
    "op2_quality_rules": op2_quality_rules,
    "op3_prefix_token_counts": op3_prefix_token_counts,
    "op4_html_layout": op4_html_layout,
    "op5_string_tiling_decontamination": op5_string_tiling_decontamination,
    "op6_setsketch_dedup": op6_setsketch_dedup,
    "op7_random_indexing_quality": op7_random_indexing_quality,
    "op8_warc_round_trip": op8_warc_round_trip,
    "op9_prefix_target_chat": op9_prefix_target_chat,
    "op10_pattern_packing": op10_pattern_packing,
    "op11_merkle_butterfly": op11_merkle_butterfly,
    "op12_count_vector_rtree": op12_count_vector_rtree,
    "op13_cholesky_jacobi_whitening": op13_cholesky_jacobi_whitening,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
