"""Item similarity kept from day to day: co-occurrence counts and degrees change with the users whose items changed.

Two state tables (``sources/state.py``): pairs ``(user_id = item i, tag = item j, n)`` for i < j, the users that hold both, and
degrees ``(user_id = item, n)``. A day gives ``changed_items``: the items that users gained or lost. Only these users' pairs are made: +1 for
a pair in their new items with a gained one in it, -1 for a pair in their old items with a lost one. So a day costs pairs of changed users,
not of all, and writes the counts that differ; the top k reads the counts and makes no pairs at all.

A user's pairs are made gained (or lost) item by item against the user's items in blocks of
``BLOCK`` items a side, so a user with very many items is spread over bounded tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..session import cut_lineage, scratch_scope
from ..sources.adapters import dt_key
from ..sources.state import StateStore
from .similarity import top_k

BLOCK = 1024
PAIR_SCHEMA = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("tag", T.StringType()), T.StructField("n", T.LongType())])
DEGREE_SCHEMA = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("n", T.LongType())])


def pair_store(spark: SparkSession, base: str, **layout) -> StateStore:
    return StateStore(spark, f"{base.rstrip('/')}/pairs", PAIR_SCHEMA, ("user_id", "tag"), **layout)


def degree_store(spark: SparkSession, base: str, **layout) -> StateStore:
    return StateStore(spark, f"{base.rstrip('/')}/degrees", DEGREE_SCHEMA, ("user_id",), **{"spread": 1} | layout)


def changed_items(old: DataFrame, new: DataFrame) -> DataFrame:
    """(user_id, item, was, now) of the users whose items differ: each of their items, and whether they held it before and hold it now."""
    both = old.select("user_id", "item", F.lit(1).alias("was"), F.lit(0).alias("now")).unionByName(
        new.select("user_id", "item", F.lit(0).alias("was"), F.lit(1).alias("now")))
    items = cut_lineage(both.groupBy("user_id", "item").agg((F.max("was") == 1).alias("was"), (F.max("now") == 1).alias("now")), "items-both")
    users = items.where("was != now").select(F.col("user_id").alias("of")).distinct()
    return items.join(users, F.col("user_id").eqNullSafe(F.col("of")), "left_semi")


def pair_changes(items: DataFrame, block: int = BLOCK) -> DataFrame:
    """(user_id = i, tag = j, by): by how many users the count of each pair i < j changes, from ``changed_items``; no zeros."""
    per_user = items.groupBy("user_id").agg(F.ceil(F.count_if(F.col("was") != F.col("now")) / block).cast("int").alias("na"), F.ceil(F.count("*") / block).cast("int").alias("nb"))
    per_user = per_user.withColumnRenamed("user_id", "of")
    dealt = items.join(per_user, F.col("user_id").eqNullSafe(F.col("of"))).drop("of")
    part = [F.pmod(F.xxhash64("item", F.lit(seed)), F.col(n)).cast("int") for seed, n in ((3, "na"), (4, "nb"))]
    # a user without an id is a user too: the keys of the blocks are null-safe by a flag
    user = [F.coalesce("user_id", F.lit("")).alias("u"), F.col("user_id").isNull().alias("no")]
    changed = dealt.where("was != now").select(*user, part[0].alias("a"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"), F.col("item").alias("x"), F.col("now").alias("gained"))
    held = dealt.select(*user, F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("a"), part[1].alias("b"), F.col("item").alias("y"), "was", "now")
    met = changed.join(held, ["u", "no", "a", "b"]).where("x != y")
    # a gained item counts with what the user holds now, a lost one with what they held; a pair of two such is met from both ends, and counted at one
    whole = F.when(F.col("gained"), F.col("now")).otherwise(F.col("was"))
    once = (F.col("was") == F.col("now")) | (F.col("x") < F.col("y"))
    step = F.when(F.col("gained"), 1).otherwise(-1)
    pairs = met.where(whole & once).select(F.least("x", "y").alias("user_id"), F.greatest("x", "y").alias("tag"), step.alias("by"))
    return pairs.groupBy("user_id", "tag").agg(F.sum("by").cast("long").alias("by")).where("by != 0")


def degree_changes(items: DataFrame) -> DataFrame:
    """(user_id = item, by): by how many users each item's degree changes."""
    step = F.when(F.col("now"), 1).otherwise(-1)
    return items.where("was != now").groupBy(F.col("item").alias("user_id")).agg(F.sum(step).cast("long").alias("by")).where("by != 0")


def _added(store: StateStore, prev_dt: str | None, by: DataFrame) -> DataFrame:
    """The store's changes for counts that rise or fall: new counts, and those that fell to nothing as deleted."""
    keys = list(store.keys)
    old = store.cells_of(prev_dt, by).withColumnRenamed("n", "old_n")
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    n = F.coalesce("old_n", F.lit(0)) + F.col("by")
    return by.alias("b").join(old.alias("o"), same, "left").select(*[f"b.{k}" for k in keys], n.alias("n"), (n <= 0).alias("deleted"))


def pair_job(spark: SparkSession, base: str, dt: str, prev_dt: str | None, old: DataFrame, new: DataFrame, block: int = BLOCK, **layout) -> int:
    """Bring the kept counts of ``prev_dt`` to ``dt``: ``old`` and ``new`` are (user_id, item) before and after. Returns the pairs whose count changed.

    Without a day before, ``old`` is what the counts start from: pass an empty table.
    """
    pairs, degrees = pair_store(spark, base, **layout), degree_store(spark, base, **layout)
    if prev_dt and dt_key(prev_dt) not in degrees.dates():
        raise FileNotFoundError(f"{base} has no degrees of {dt_key(prev_dt)}: run its job again")
    with scratch_scope(spark):
        items = cut_lineage(changed_items(old, new), "items-changed")
        by = cut_lineage(pair_changes(items, block), "pairs-changed")
        degrees.commit(dt, prev_dt, _added(degrees, prev_dt, cut_lineage(degree_changes(items), "degrees-changed")))
        return_rows = by.count()
        pairs.commit(dt, prev_dt, _added(pairs, prev_dt, by))
    return return_rows


def kept_top_k(spark: SparkSession, base: str, dt: str, k: int = R.TOP_K) -> DataFrame:
    """(item, neighbour, c, score, rank) of the k best neighbours of each item, from the counts of a date."""
    pairs = pair_store(spark, base).read(dt).select(F.col("user_id").alias("i"), F.col("tag").alias("j"), F.col("n").alias("c"))
    degrees = degree_store(spark, base).read(dt)
    for end in ("i", "j"):
        pairs = pairs.join(degrees.select(F.col("user_id").alias(end), F.col("n").alias(f"n{end}")), end)
    score = F.col("c").cast("double") / F.sqrt(F.col("ni").cast("double") * F.col("nj").cast("double"))
    ends = [F.struct(F.col(a).alias("item"), F.col(b).alias("neighbour"), "c", score.alias("score")) for a, b in (("i", "j"), ("j", "i"))]
    return top_k(pairs.select(F.inline(F.array(*ends))), k).select("item", "neighbour", "c", "score", "rank")
