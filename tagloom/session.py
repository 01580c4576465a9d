"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tagloom",
                  scratch: str | None = None) -> SparkSession:
    """A local[*] session configured like the cluster jobs expect (AQE on, UI off, UTC).

    ``scratch`` (a fresh folder) receives the event log and, when the session
    has none, the checkpoint folder.
    """
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local fixtures are small: keep AQE from merging a compact shuffle (e.g. item
        # arrays that expand into many pairs) into fewer tasks than cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if scratch:
        os.makedirs(scratch, exist_ok=True)
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", scratch)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if scratch:
        ensure_checkpoint_dir(spark, os.path.join(scratch, "checkpoints"))
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder in that setting. Only when it is unset
    and the master is local (tests, bench) do we create one under /tmp;
    on a cluster an unset folder is an error rather than a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running multi-day jobs")
    path = fallback or tempfile.mkdtemp(prefix="tagloom-ckpt-", dir="/tmp")
    os.makedirs(path, exist_ok=True)
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the intermediate tables and folders (``cut_lineage``, ``scratch_folder``) made inside the block on exit.

    Use it around a job whose results are consumed (written or collected) inside
    the block; DataFrames returned from inside must not be used after it.
    """
    stack = getattr(_scopes, "stack", None)
    if stack is None:
        stack = _scopes.stack = []
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            drop_path(spark, path)


def cut_lineage(df: DataFrame, name: str = "stage", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table under the shared checkpoint folder.

    One write job (``Dataset.checkpoint`` would compute the plan twice), and the
    table survives executor loss because it lives on the cluster's shared storage.
    ``partition_by`` lets later filters on those columns prune directories.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    out = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    out._tagloom_path = path  # lets a caller drop a superseded intermediate table
    return out


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, deleted with the innermost scope (``scratch_scope``), if there is one."""
    path = scratch_table_path(spark, name)
    if getattr(_scopes, "stack", None):
        _scopes.stack[-1].append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table folder we wrote under the checkpoint folder (recursive)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for an intermediate table."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
