"""Awkward tables that every operator has to take, and small helpers."""

from __future__ import annotations

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"

SHARED = "the quick brown fox jumps over the lazy dog and then it sleeps under the old oak tree until the evening comes again"
#: (doc_id, text): null id, null, empty and blank texts, a very long one, repeated rows, copies.
AWKWARD = [
    (None, SHARED), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "word " * 60000), (5, SHARED), (5, SHARED),
    (6, SHARED), (7, "x" * 150000), (8, "one two"), (9, "one two"), (10, "é ü 中文 <|endoftext|> \x85 \x00 ok"),
]
#: Further columns whose names operators use themselves.
EXTRA = ("kept", "component_id", "rank", "task", "group", "signature", "label", "n_words", "rep", "first", "size", "gone", "repeated")


def documents(spark, rows=AWKWARD):
    """A documents table of (doc_id, text) rows with all its columns and clashing further ones."""
    schema = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long", *(f"{c} string" for c in EXTRA)])
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), *(["x"] * len(EXTRA))) for i, t in rows], schema)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def read(name: str, columns: list[str], sf: str = SF) -> list[tuple]:
    t = pq.read_table(f"{sf}/{name}.parquet", columns=columns)
    return list(zip(*(t[c].to_pylist() for c in columns)))


def rows_of(df, key=None) -> list:
    return sorted(df.collect(), key=key or (lambda r: tuple((v is None, str(v)) for v in r)))
