"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(doc_id):
    """crc32 of the id as text, modulo FOLDS."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


def labelled_texts(docs: DataFrame, labels: DataFrame, target: str, max_rows: int) -> DataFrame:
    """(doc_id, text, label, fold) of at most ``max_rows`` labelled documents outside fold 0, chosen by a hash of the id.

    Rows without a label of 0 or 1 or without an id are passed over; of several labels of one id the
    greatest counts, of several rows of one id the least text (copies are reduced where they are read). So a sample is
    at most ``max_rows`` rows, and the broadcast labels as many; texts are whole.
    """
    ids = F.col("doc_id").cast("long")
    rows = (labels.select(ids.alias("labelled"), F.col(target).cast("int").alias("label"))
            .where("labelled IS NOT NULL AND label IN (0, 1)")
            .where(fold(F.col("labelled")) != 0)
            .groupBy("labelled").agg(F.max("label").alias("label"))
            .orderBy(F.xxhash64("labelled"), "labelled").limit(max_rows))
    texts = docs.select(ids.alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(rows), texts["doc_id"] == rows["labelled"])
    return (met.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
            .select("doc_id", "text", "label", fold(F.col("doc_id")).alias("fold")))
