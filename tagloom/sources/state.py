"""Change-only state: a bucketed base, then one delta a day with the cells that changed, merged when read.

``<base>/dt=<date>/v=<version>/`` holds a base (every cell) or a delta: changed cells, and with ``deleted`` set
the keys of cells that ceased to be. ``_state.json`` in it says which, how it is laid out and which version of
which earlier date it builds on; ``dt=<date>/_current-<version>``, created last, puts a version in force. So day
n writes what day n changed, a reader follows the chain back to a base, and the newest row of a key counts.

* Versions of a date are numbered on from the one they replace, not by a clock. The replaced one stays until the
  next commit of its date, and for as long as the version in force of a later date builds on it, so readers
  that planned on either finish.
* A new base is written when the deltas since the last hold more than ``compact_share`` of its cells, or are
  ``most_deltas``.
* Rows are bucketed and sorted by ``deal``, a hash of user and key, so that a join with a day's users never moves the
  state, and a few users' buckets are the only ones read. A user's cells lie in at most ``spread`` deals, so a user who
  holds a large part of all cells is spread over as many tasks.

On disk a null user is an empty one with a negative deal.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .adapters import dt_key

META = "_state.json"
#: A day with at most this many deals reads the buckets of these only; their numbers are literals in the plan.
PRUNED_DEALS = 1024
DEALS_PER_BUCKET = 64


@dataclass(frozen=True)
class Version:
    """One written version of a date."""

    dt: str
    name: str
    kind: str  # base or delta
    rows: int
    buckets: int
    spread: int
    parent: tuple[str, str] | None = None  # (dt, name) that a delta builds on


@dataclass(frozen=True)
class StateStore:
    """The state tables of one job under ``base``; ``schema`` without the columns that this module adds."""

    spark: SparkSession
    base: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 64
    spread: int = 8
    compact_share: float = 0.5
    most_deltas: int = 30
    by_family: bool = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "by_family", "family" in self.schema.names)

    # --- files ------------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _date(self, dt: str) -> str:
        return f"{self.base.rstrip('/')}/dt={dt_key(dt)}"

    def path(self, v: Version) -> str:
        return f"{self._date(v.dt)}/v={v.name}"

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []

    def _committed(self, dt: str) -> list[str]:
        """Names of the committed versions of a date that are still there, oldest first."""
        return [n.removeprefix("_current-") for n in self._names(self._date(dt)) if n.startswith("_current-")]

    def version(self, dt: str, name: str | None = None) -> Version | None:
        """A version of a date, by default the one in force (None if the date has none)."""
        if name is None:
            committed = self._committed(dt)
            if not committed:
                return None
            name = committed[-1]
        fs, p = self._fs(f"{self._date(dt)}/v={name}/{META}")
        stream = fs.open(p)
        try:
            meta = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(dt_key(dt), name, meta["kind"], meta["rows"], meta["buckets"], meta["spread"],
                       tuple(meta["parent"]) if meta["parent"] else None)

    def chain(self, dt: str, version: Version | None = None) -> list[Version]:
        """The versions that make up the state of a date, newest first, down to a base."""
        out = [version or self.version(dt)]
        if out[0] is None:
            raise FileNotFoundError(f"no committed state of {dt_key(dt)} in {self.base}")
        while out[-1].parent:
            out.append(self.version(*out[-1].parent))
        return out

    def dates(self) -> list[str]:
        return [n.removeprefix("dt=") for n in self._names(self.base) if n.startswith("dt=") and self._committed(n.removeprefix("dt="))]

    # --- layout -----------------------------------------------------------------

    def _deal(self, user: Column, spread: int, buckets: int, part: Column) -> Column:
        deal = F.pmod(F.xxhash64(user) + part, F.lit(buckets * DEALS_PER_BUCKET)).cast("int")
        return F.when(user.isNull(), F.lit(-1) - part.cast("int")).otherwise(deal)

    def _dealt(self, rows: DataFrame, spread: int, buckets: int) -> DataFrame:
        others = [k for k in self.keys if k != "user_id"]
        part = F.pmod(F.xxhash64(*others), F.lit(spread)) if others else F.lit(0).cast("long")
        deal = self._deal(F.col("user_id"), spread, buckets, part)
        return rows.withColumn("deal", deal).withColumn("user_id", F.coalesce("user_id", F.lit("")))

    def _plain(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("user_id", F.when(F.col("deal") >= 0, F.col("user_id")))

    def _disk_schema(self, kind: str) -> T.StructType:
        fields = [*self.schema.fields, T.StructField("deal", T.IntegerType())]
        return T.StructType(fields + ([T.StructField("deleted", T.BooleanType())] if kind == "delta" else []))

    def _write(self, rows: DataFrame, dt: str, kind: str, parent: Version | None) -> Version:
        before = self._committed(dt)
        name = f"{(int(before[-1].split('-')[0]) if before else 0) + 1:020d}-{uuid.uuid4().hex[:8]}"
        path, table = f"{self._date(dt)}/v={name}", f"tagloom_{uuid.uuid4().hex}"
        names = [f.name for f in self._disk_schema(kind).fields]
        w = self._dealt(rows, self.spread, self.buckets).select(*names).repartition(self.buckets, "deal").write.bucketBy(
            self.buckets, "deal").sortBy("deal", "user_id").option("path", path).option("parquet.bloom.filter.enabled#user_id", "true")
        (w.partitionBy("family") if self.by_family else w).saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")  # the catalog's entry: the files are the store's
        count = self.spark.read.schema(self._disk_schema(kind)).parquet(path).count()  # from the files' footers
        v = Version(dt_key(dt), name, kind, count, self.buckets, self.spread, (parent.dt, parent.name) if parent else None)
        fs, p = self._fs(f"{path}/{META}")
        out = fs.create(p, False)
        out.write(bytearray(json.dumps({"kind": v.kind, "rows": v.rows, "buckets": v.buckets, "spread": v.spread, "parent": v.parent}).encode()))
        out.close()
        return v

    def _put_in_force(self, v: Version) -> None:
        fs, p = self._fs(f"{self._date(v.dt)}/_current-{v.name}")
        fs.create(p, False).close()

    def _clean(self, dt: str) -> None:
        """Delete what lies before the version that the last commit replaced, unless a later date builds on it."""
        committed = self._committed(dt)
        keep = set(committed[-2:])
        for later in (d for d in self.dates() if d > dt_key(dt)):
            for name in self._committed(later)[-2:]:
                keep |= {v.name for v in self.chain(later, self.version(later, name)) if v.dt == dt_key(dt)}
        if len(committed) < 2:
            return
        fs, _ = self._fs(self._date(dt))
        for name in self._names(self._date(dt)):
            own = name.removeprefix("v=").removeprefix("_current-")
            if name.startswith(("v=", "_current-")) and own < committed[-2] and own not in keep:
                fs.delete(self._fs(f"{self._date(dt)}/{name}")[1], True)

    # --- reading ----------------------------------------------------------------

    def _rows(self, v: Version) -> DataFrame:
        """A version's rows; a family filter prunes its directories."""
        return self.spark.read.schema(self._disk_schema(v.kind)).option("basePath", self.path(v)).parquet(self.path(v))

    def _bucketed(self, v: Version) -> list[DataFrame]:
        """A version's rows as tables that Spark knows to be bucketed by deal, one for each family."""
        out = []
        names = [n for n in self._names(self.path(v)) if n.startswith("family=")] if self.by_family else [""]
        for name in names:
            fields = [f for f in self._disk_schema(v.kind).fields if f.name != "family"]
            table = f"tagloom_{uuid.uuid4().hex}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            location = f"{self.path(v)}/{name}".rstrip("/").replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (deal) SORTED BY (deal, user_id) "
                           f"INTO {v.buckets} BUCKETS LOCATION '{location}'")
            rows = self.spark.table(table)
            out.append(rows.withColumn("family", F.lit(name.removeprefix("family="))) if name else rows)
            self.spark.sql(f"DROP TABLE {table}")  # the frame holds the files' list and their buckets
        return out

    def _newest(self, rows: DataFrame) -> DataFrame:
        """The newest row of each key, by ``seq``."""
        values = [f.name for f in self.schema.fields if f.name not in self.keys]
        last = rows.groupBy(*self.keys, "deal").agg(F.max_by(F.struct(*values, "deleted"), "seq").alias("last"))
        return last.select(*self.keys, "deal", "last.*")

    def read(self, dt: str, families: list[str] | None = None, version: Version | None = None) -> DataFrame:
        """Every cell of the state of a date (of the families wanted): base cells without newer rows, and the newest rows that live."""
        *deltas, base = self.chain(dt, version)

        def wanted(v):
            return self._rows(v).where(F.col("family").isin(*families)) if families else self._rows(v)

        out = wanted(base)
        if deltas:
            union = reduce(DataFrame.unionByName, [wanted(v).withColumn("seq", F.lit(i)) for i, v in enumerate(reversed(deltas))])
            newest = self._newest(union) if len(deltas) > 1 else union.drop("seq")
            out = out.join(newest.select(*self.keys, "deal"), [*self.keys, "deal"], "left_anti").unionByName(newest.where("NOT deleted").drop("deleted"))
        return self._plain(out).select(*self.schema.names)

    def cells_of(self, dt: str | None, users: DataFrame) -> DataFrame:
        """The state's cells of these users (user_id) only, written once: each version is scanned once and not moved.

        Spark joins the bucketed files with the users dealt likewise. If the users have few deals, only the
        buckets of these are read.
        """
        if dt is None:
            return self.spark.createDataFrame([], self.schema)
        found = []
        ids = users.select("user_id").distinct()
        dealt: dict[tuple[int, int], tuple[DataFrame, list[int]]] = {}
        with self._co_located():
            for seq, v in enumerate(reversed(self.chain(dt))):
                layout = (v.spread, v.buckets)
                if layout not in dealt:
                    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(v.spread - 1).cast("long"))).alias("part")
                    of = ids.select("user_id", parts).select(F.coalesce("user_id", F.lit("")).alias("user_id"),
                                                             self._deal(F.col("user_id"), v.spread, v.buckets, F.col("part")).alias("deal"))
                    of = cut_lineage(of, "state-users")
                    dealt[layout] = of, [r[0] for r in of.select("deal").distinct().limit(PRUNED_DEALS + 1).collect()]
                of, deals = dealt[layout]
                for rows in self._bucketed(v):
                    if len(deals) <= PRUNED_DEALS:
                        rows = rows.where(F.col("deal").isin(*deals))
                    rows = rows if v.kind == "delta" else rows.withColumn("deleted", F.lit(False))
                    found.append(rows.join(of, ["deal", "user_id"], "left_semi").select(*self.schema.names, "deal", "deleted", F.lit(seq).alias("seq")))
            if not found:
                return self.spark.createDataFrame([], self.schema)
            rows = cut_lineage(reduce(DataFrame.unionByName, found), "state-cells")
        newest = self._newest(rows) if len(found) > 1 else rows
        return self._plain(newest.where("NOT deleted")).select(*self.schema.names)

    @contextmanager
    def _co_located(self):
        """Rows bucketed by deal are co-located for a join on deal and more; Spark takes that into account if told so."""
        name = "spark.sql.requireAllClusterKeysForCoPartition"
        old = self.spark.conf.get(name)
        self.spark.conf.set(name, "false")
        try:
            yield
        finally:
            self.spark.conf.set(name, old)

    # --- writing ----------------------------------------------------------------

    def commit(self, dt: str, prev_dt: str | None, changes: DataFrame) -> Version:
        """Write the state of ``dt``: that of ``prev_dt`` with changes (the schema's columns, and ``deleted``) on top.

        A base if there is nothing before it or the rule for compaction says so, else a delta of the changes.
        """
        if prev_dt is None:
            v = self._write(changes.where("NOT deleted").select(*self.schema.names), dt, "base", None)
        else:
            below = self.chain(prev_dt)
            v = self._write(changes, dt, "delta", below[0])
            deltas, base = [v, *below[:-1]], below[-1]
            if len(deltas) > self.most_deltas or sum(x.rows for x in deltas) > self.compact_share * base.rows:
                whole = self.read(dt, version=v)
                fs, p = self._fs(self.path(v))
                v = self._write(whole, dt, "base", None)
                fs.delete(p, True)
        self._put_in_force(v)
        self._clean(dt)
        return v
