"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All stages but the last keep the columns of documents. Null, empty
and very long texts, repeated rows, empty tables and further columns pass through as the operators
in tagloom.llm define; null and empty texts fail the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import decontaminate, packing, pii, quality_rules, setsketch
from tagloom.session import cut_lineage
from tagloom.sources.tables import table


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the calibrated classifier keep (op2)."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id (op6)."""
    return setsketch.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in order or rearranged (op5)."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in the text (op1)."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token pieces with their sequences and offsets (op10)."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", keep_good_quality),
    ("near_dedup", keep_one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

# trained classifiers, sketches and tokenizers are beyond SQL; tests compare run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs, name)
    return docs
