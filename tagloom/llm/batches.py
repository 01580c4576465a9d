"""Arrow-batch helpers shared by the operators: bounded slices of texts, and streams of adjacent groups."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import tagloom
from tagloom.llm import textvec

PACKAGE = "tagloom-package.zip"


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, so that tasks can import it wherever they run.

    Nothing is done where the package comes from an archive: it was shipped with the job then.
    """
    sc, root = spark.sparkContext, os.path.dirname(os.path.abspath(tagloom.__file__))
    if PACKAGE in {os.path.basename(p) for p in sc._python_includes} or not os.path.isdir(root):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tagloom-"), PACKAGE)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tagloom", os.path.relpath(full, root)))
    sc.addPyFile(path)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` whose tasks find this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def text_slices(batch: pa.RecordBatch, text: str = "text", limit: int = textvec.SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``limit`` bytes of text each (a longer text is a piece of its own)."""
    _, offsets = textvec.flat(batch.column(text))
    for a, b in textvec.slices(offsets, limit):
        yield batch.slice(a, b - a)


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
              text: str = "text", limit: int = textvec.SLICE_BYTES) -> DataFrame:
    """``fn`` over bounded slices of every Arrow batch; memory follows the slice, not the batch."""

    def run(batches):
        for batch in batches:
            for piece in text_slices(batch, text, limit):
                yield fn(piece)

    return map_arrow(df, run, schema)


def strings(column: pa.Array) -> list[str]:
    """Python strings of a column; null counts as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def adjacent_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of adjacent rows with equal keys (integer columns without nulls), over batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in keys])
        cuts = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            now = tuple(k[:, a].tolist())
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            last = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
