"""Recommendation push: seed item per user, neighbour lookup, push rows.

Push rows carry the fixed schema (ID, MEMBER_ID, PROD_ID, STATUS). IDs are
deterministic ``md5(member|prod|run_dt)`` (32 hex chars) so a re-run or a
recomputed partition writes the same IDs; ``id_mode='random'`` uses ``randstr(32)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from .interest import PRODUCT_FAMILY
from .similarity import DEFAULT_CHUNK_ITEMS, similarity_top_k

PUSH_SCHEMA = T.StructType([
    T.StructField("ID", T.StringType(), True),
    T.StructField("MEMBER_ID", T.StringType(), False),
    T.StructField("PROD_ID", T.StringType(), True),
    T.StructField("STATUS", T.IntegerType(), True),
])


def product_family(state: DataFrame) -> DataFrame:
    """(user_id, tag, weight) of the product family (family pruned at the scan for a snapshot)."""
    return state.where(F.col("family") == PRODUCT_FAMILY).select("user_id", "tag", "weight")


def user_items(state: DataFrame) -> DataFrame:
    """Distinct (user_id, item): product keys with the ``prod_`` prefix stripped."""
    prefix_len = len(R.PRODUCT_PREFIX)
    # a state has one row per (user, family, tag), so these are distinct as they are
    return product_family(state).select("user_id", F.substring("tag", prefix_len + 1, 1 << 30).alias("item"))


def seed_item(state: DataFrame, seed: str = "max") -> DataFrame:
    """(user_id, item, weight): the user's highest weighted product (lowest with ``seed='min'``).

    Ties go to the smaller item id. min_by over a struct aggregates partially, so a
    user with many products never collects them into one group.
    """
    p = product_family(state).select("user_id", F.substring("tag", len(R.PRODUCT_PREFIX) + 1, 1 << 30).alias("item"),
                                     "weight")
    if seed == "max":
        order = F.struct((-F.col("weight")).alias("w"), F.col("item").alias("i"))
    elif seed == "min":
        order = F.struct(F.col("weight").alias("w"), F.col("item").alias("i"))
    else:
        raise ValueError("seed must be 'max' or 'min'")
    best = F.min_by(F.struct("item", "weight"), order)
    return p.groupBy("user_id").agg(best.alias("b")).select("user_id", "b.item", "b.weight")


def push_candidates(state: DataFrame, seed: str = "max", k: int = R.TOP_K, exclude_seen: bool = False,
                    chunk_items: int = DEFAULT_CHUNK_ITEMS, keep_unmatched: bool = False) -> DataFrame:
    """(user_id, seed, neighbour, rank): the seed's top-k neighbours for every user.

    The neighbour table is joined, not collected to the driver; AQE turns the join
    into a broadcast only when the runtime size of the top-k table is under the
    broadcast threshold. ``keep_unmatched`` keeps users whose seed has no
    neighbour (one row with NULL neighbour).
    """
    top = similarity_top_k(user_items(state), k, chunk_items, unique=True).select(
        F.col("item").alias("seed"), "neighbour", "rank")
    seeds = seed_item(state, seed).select("user_id", F.col("item").alias("seed"))
    cand = seeds.join(top, "seed", "left" if keep_unmatched else "inner")
    if exclude_seen:
        seen = user_items(state).select("user_id", F.col("item").alias("neighbour"))
        cand = cand.join(seen, ["user_id", "neighbour"], "left_anti")
    return cand.select("user_id", "seed", "neighbour", "rank")


def push_rows(state: DataFrame, run_dt: str, seed: str = "max", k: int = R.TOP_K, exclude_seen: bool = False,
              id_mode: str = "md5", chunk_items: int = DEFAULT_CHUNK_ITEMS) -> DataFrame:
    cand = push_candidates(state, seed, k, exclude_seen, chunk_items)
    if id_mode == "md5":
        rid = F.md5(F.concat_ws("|", F.col("user_id"), F.col("neighbour"), F.lit(str(run_dt))))
    elif id_mode == "random":
        rid = F.randstr(32)
    else:
        raise ValueError("id_mode must be 'md5' or 'random'")
    return cand.select(rid.alias("ID"), F.col("user_id").alias("MEMBER_ID"),
                       F.col("neighbour").alias("PROD_ID"), F.lit(1).cast("int").alias("STATUS"))


def push_lists(state: DataFrame, seed: str = "max", k: int = R.TOP_K,
               chunk_items: int = DEFAULT_CHUNK_ITEMS) -> DataFrame:
    """(MEMBER_ID, PROD_IDS): the ranked neighbour list of every user with products;
    a seed without neighbours gives an empty list (and so no push rows)."""
    cand = push_candidates(state, seed, k, False, chunk_items, keep_unmatched=True)
    entry = F.when(F.col("neighbour").isNotNull(), F.struct("rank", "neighbour"))
    ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["neighbour"])
    return (cand.groupBy("user_id").agg(F.array_join(ordered, ",").alias("PROD_IDS"))
            .select(F.col("user_id").alias("MEMBER_ID"), "PROD_IDS"))


def push_preview(rows: DataFrame, n: int = 10) -> DataFrame:
    """The first n push rows in a stable order (the console preview of the job)."""
    return rows.orderBy("MEMBER_ID", "PROD_ID").limit(n)
