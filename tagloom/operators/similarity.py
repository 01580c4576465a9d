"""Item-item cosine similarity of binary user-item vectors and the top-k neighbour cut.

s(i, j) = c_ij / sqrt(n_i * n_j), c_ij = users having both, n_i = users having i.

Scale notes
-----------
* Items are keyed by dense numbers in the order of their strings while pairs are
  generated, counted and ranked, so (score, number) orders neighbours as (score, string)
  does. The dictionary of items is numbered by a range sort (rows per task, and offsets); rows get
  their numbers through a 64-bit hash of the string, which is checked: if two strings share a
  hash, all items are hashed again with another salt.
* Every user-item row gets its item's degree n before pairs are made, so a pair
  carries both degrees and its score needs no join on the pair table: after
  generation, pairs are shuffled once to be counted and once to be ranked.
* A user's distinct items are grouped into chunks of about ``chunk_items`` (by
  item hash) with a partially aggregated ``collect_list``. Light users (the common
  case) form one chunk and their pairs (i < j) come from that bounded array.
* The chunks of a user with several of them are joined one-to-one on (user, a, b),
  a < b, so a user holding a third of all rows is spread over many bounded tasks.
* Users above ``heavy_items`` items take no part in pair generation at all; see
  ``similarity_top_k``.
* Where items are many, so that pairs seldom repeat within a task, the top k does not move pairs: see ``_top_k_by_item``.
* Top-k: a rank by (score, number), which has no ties, so that the partial
  WindowGroupLimit before the shuffle leaves at most k rows of an item in a task, however
  many neighbours share the score at the cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..session import cut_lineage

DEFAULT_CHUNK_ITEMS = 1024
DEFAULT_HEAVY_ITEMS = 8192
SALTS = 8  # item keys are tried with so many salts before giving up
FEW_PAIRS = 1 << 20  # a task holds the counts of so many possible pairs, and sends each of them once
PAIRS_A_TASK = 1 << 21  # pairs that one task counts
HUB_USERS = 1 << 14  # items of more users are counted in several tasks
HUB_LEVELS = 24


def _item_key(salt: int) -> Column:
    return F.xxhash64("item") if not salt else F.xxhash64("item", F.lit(salt))


def _keyed(user_items: DataFrame, unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """(user_id, item=number) rows and the (iid=number, item string) dictionary; numbers rise with the strings.

    Both are written once to the shared checkpoint folder, so that the branches that
    read them scan them instead of recomputing the input, and restart from them after
    an executor loss. ``unique`` says that the input has no repeated rows.
    """
    rows = user_items.select("user_id", "item")
    rows = cut_lineage(rows if unique else rows.distinct(), "similarity-user-items")
    for salt in range(SALTS):
        names = cut_lineage(rows.select(_item_key(salt).alias("hash"), "item").distinct(), "similarity-names")
        if names.groupBy("hash").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError(f"items share hashes under {SALTS} salts")
    named = cut_lineage(_numbered(names), "similarity-items")
    keyed = rows.select("user_id", _item_key(salt).alias("hash")).join(named.select("hash", "iid"), "hash")
    return cut_lineage(keyed.select("user_id", F.col("iid").alias("item")), "similarity-keyed"), named.select("iid", "item")


def _numbered(names: DataFrame, by: tuple[str, ...] = ("item",)) -> DataFrame:
    """names with ``iid``, their dense number from 0 in the order of ``item``, or of the columns ``by``."""
    placed = names.repartitionByRange(*by).sortWithinPartitions(*by).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    placed = cut_lineage(placed, "similarity-order")
    counts = placed.groupBy("part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))  # a row for each task
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(shift, "part").select(*names.columns, (F.col("at") + F.col("shift")).alias("iid"))


def _decode(df: DataFrame, dictionary: DataFrame, cols=("item", "neighbour")) -> DataFrame:
    out = df
    for c in cols:
        out = (out.join(dictionary.select(F.col("iid").alias(c), F.col("item").alias(f"_{c}")), c)
               .drop(c).withColumnRenamed(f"_{c}", c))
    return out


def _big_users(enc: DataFrame, bound: int) -> DataFrame:
    """(user_id, d) of users with more than ``bound`` items: at most rows / bound of them, written once."""
    counts = enc.groupBy("user_id").agg(F.count(F.lit(1)).alias("d"))
    return cut_lineage(counts.where(F.col("d") > bound), "similarity-big-users")


def _with_degrees(enc: DataFrame, big: DataFrame, heavy_items: int | None = None) -> DataFrame:
    """(user_id, item, d, n, h): d = the user's size if big, n = the item's users, h = how many of them are heavy."""
    rows = enc.join(big, "user_id", "left")
    heavy = F.coalesce(F.col("d") > heavy_items, F.lit(False)) if heavy_items else F.lit(False)
    degree = rows.groupBy("item").agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.count_if(heavy).cast("bigint").alias("h"))
    return rows.join(degree, "item").select("user_id", "item", "d", "n", "h")


def _lists(rows: DataFrame, chunk_items: int) -> DataFrame:
    """(user_id, chunk, nc, items) from distinct rows with degrees: nc bounded chunks per user."""
    nc = F.coalesce(F.ceil(F.col("d") / F.lit(chunk_items)).cast("int"), F.lit(1))
    chunk = F.pmod(F.xxhash64("item"), nc).cast("int")
    return (rows.groupBy("user_id", chunk.alias("chunk"), nc.alias("nc"))
            .agg(F.array_sort(F.collect_list(F.struct("item", "n", "h"))).alias("items")))  # rows are distinct already


def _pairs(lists: DataFrame, across_chunks: bool = True) -> DataFrame:
    """(i, j, c, ni, nj, hi, hj): users that hold both, and both items' degrees, per unordered pair."""
    # pairs inside a chunk: each element with the elements after it (generators stay in codegen)
    pairs = (lists.select("items", F.posexplode("items").alias("p", "x"))
             .select("x", F.explode(F.slice("items", F.col("p") + 2, F.size("items"))).alias("y")))
    if across_chunks:
        # pairs across chunks a < b of a big user: one row per (user, a, b) on each side
        multi = lists.where(F.col("nc") > 1)
        other = F.explode(F.sequence(F.lit(0), F.col("nc") - 1)).alias("other")
        keyed = multi.select("user_id", "chunk", "items", other)
        a = keyed.where(F.col("chunk") < F.col("other")).select(
            "user_id", F.col("chunk").alias("ca"), F.col("other").alias("cb"), F.col("items").alias("xa"))
        b = keyed.where(F.col("chunk") > F.col("other")).select(
            "user_id", F.col("other").alias("ca"), F.col("chunk").alias("cb"), F.col("items").alias("xb"))
        across = (a.join(b, ["user_id", "ca", "cb"]).select(F.explode("xa").alias("x"), "xb")
                  .select("x", F.explode("xb").alias("y"))
                  .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")))
        pairs = pairs.unionByName(across)
    flat = pairs.select(F.col("x.item").alias("i"), F.col("y.item").alias("j"), F.col("x.n").alias("ni"), F.col("y.n").alias("nj"),
                        F.col("x.h").alias("hi"), F.col("y.h").alias("hj"))
    return flat.groupBy("i", "j").agg(F.count(F.lit(1)).cast("bigint").alias("c"), *(F.max(x).alias(x) for x in ("ni", "nj", "hi", "hj")))


def _both_directions(pairs: DataFrame) -> DataFrame:
    """(item, neighbour, c, n, m, h, g): every pair from both ends; n, h are the item's, m, g the neighbour's."""
    def end(i, j, ni, nj, hi, hj):
        return F.struct(F.col(i).alias("item"), F.col(j).alias("neighbour"), F.col("c"), F.col(ni).alias("n"), F.col(nj).alias("m"),
                        F.col(hi).alias("h"), F.col(hj).alias("g"))
    return pairs.select(F.inline(F.array(end("i", "j", "ni", "nj", "hi", "hj"), end("j", "i", "nj", "ni", "hj", "hi"))))


def _cosine(c: Column) -> Column:
    return c.cast("double") / F.sqrt(F.col("n").cast("double") * F.col("m").cast("double"))


def _all_pairs(enc: DataFrame, chunk_items: int) -> DataFrame:
    big = _big_users(enc, chunk_items)
    return _both_directions(_pairs(_lists(_with_degrees(enc, big), chunk_items), not big.isEmpty()))


def item_frequency(user_items: DataFrame) -> DataFrame:
    """(item, n): distinct users per item (the diagonal of the co-occurrence matrix)."""
    return (user_items.select("user_id", "item").distinct()
            .groupBy("item").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def cooccurrence(user_items: DataFrame, chunk_items: int = DEFAULT_CHUNK_ITEMS) -> DataFrame:
    """(item, neighbour, c): both orders of every off-diagonal pair."""
    enc, dictionary = _keyed(user_items)
    return _decode(_all_pairs(enc, chunk_items).select("item", "neighbour", "c"), dictionary).select("item", "neighbour", "c")


def similarity(user_items: DataFrame, chunk_items: int = DEFAULT_CHUNK_ITEMS) -> DataFrame:
    """(item, neighbour, score) for every ordered pair that shares a user."""
    enc, dictionary = _keyed(user_items)
    scored = _all_pairs(enc, chunk_items).select("item", "neighbour", _cosine(F.col("c")).alias("score"))
    return _decode(scored, dictionary).select("item", "neighbour", "score")


def top_k(scored: DataFrame, k: int = R.TOP_K) -> DataFrame:
    """Best k neighbours of each item by score, ties by neighbour id ascending, with their rank."""
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("neighbour").asc())
    return (scored.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))


def _best(scored: DataFrame, most: int) -> DataFrame:
    """The ``most`` best rows of each item by score, ties by neighbour number, with their ``rank``.

    No rows tie but repeated ones (a neighbour found in two ways), so each task cuts to ``most`` rows an item before the shuffle.
    """
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), *([F.col("neighbour")] if "neighbour" in scored.columns else []))
    number = F.rank() if "neighbour" in scored.columns else F.row_number()
    return scored.withColumn("rank", number.over(w)).where(F.col("rank") <= most)


def _through_heavy_users(rows: DataFrame, big: DataFrame, dictionary: DataFrame, k: int, chunk_items: int,
                         heavy_items: int) -> DataFrame:
    """(item, neighbour, c, score) of the partners that heavy users alone can bring into a top k.

    c counts shared heavy users. Items with the same set of heavy holders form a group (by two hashes
    and the size of the set, which aggregate partially); only the k + 1 members of least (n, id) of
    each are offered. Offers meet the holdings of their heavy users in blocks of (user, a, b) of at
    most about ``chunk_items`` rows a side, so no task has all items of a user.
    """
    holding = rows.where(F.col("d") > heavy_items).select("user_id", "item", "n")
    sets = holding.groupBy("item").agg(F.bit_xor(F.xxhash64("user_id")).alias("s1"), F.bit_xor(F.xxhash64("user_id", F.lit(1))).alias("s2"),
                                       F.count(F.lit(1)).alias("holders"), F.max("n").alias("n"))
    named = sets.join(dictionary.select(F.col("iid").alias("item"), F.col("item").alias("name")), "item")
    offered = (named.withColumn("r", F.row_number().over(Window.partitionBy("s1", "s2", "holders").orderBy("n", "name")))
               .where(F.col("r") <= k + 1).select("item"))
    offers = cut_lineage(holding.join(offered, "item", "left_semi"), "similarity-offers")
    blocks = (offers.groupBy("user_id").agg(F.count(F.lit(1)).alias("o")).join(big, "user_id")
              .select("user_id", F.ceil(F.col("d") / chunk_items).cast("int").alias("na"),
                      F.ceil(F.col("o") / chunk_items).cast("int").alias("nb")))
    part = F.pmod(F.xxhash64("item", F.lit(2)), F.col("parts")).cast("int")
    left = (holding.join(blocks, "user_id").withColumn("parts", F.col("na"))
            .select("user_id", part.alias("a"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"), "item", "n"))
    right = (offers.join(blocks, "user_id").withColumn("parts", F.col("nb"))
             .select("user_id", F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("a"), part.alias("b"),
                     F.col("item").alias("neighbour"), F.col("n").alias("m")))
    met = left.join(right, ["user_id", "a", "b"]).where(F.col("item") != F.col("neighbour"))
    return (met.groupBy("item", "neighbour").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"), F.max("m").alias("m"))
            .select("item", "neighbour", "c", _cosine(F.col("c")).alias("score")))


def _with_heavy_users(light: DataFrame, heavy: DataFrame, holding: DataFrame, k: int) -> DataFrame:
    """(item, neighbour, c, score): light pairs that can be in a top k, with the heavy users they share added.

    A light pair shares between 0 and min(h, g) heavy users. It can matter only if its score with the
    most of them reaches the item's 2k-th best score known so far (a neighbour is known at most twice);
    only for those pairs are the shared heavy users counted, through the holdings of both items.
    """
    known = light.select("item", _cosine(F.col("c")).alias("score")).unionByName(heavy.select("item", "score"))
    floor = (_best(known, 2 * k).groupBy("item").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("known"))
             .where(F.col("known") >= 2 * k).select("item", "least"))
    most = _cosine(F.col("c") + F.least("h", "g"))
    open_ = cut_lineage(light.join(floor, "item", "left").where(F.col("least").isNull() | (most >= F.col("least")))
                        .select("item", "neighbour", "c", "n", "m", "h", "g"), "similarity-open")
    holders = holding.select(F.col("item").alias("neighbour"), "user_id")
    shared = (open_.where(F.least("h", "g") > 0).select("item", "neighbour")
              .join(holding.select("item", "user_id"), "item").join(holders, ["neighbour", "user_id"])
              .groupBy("item", "neighbour").agg(F.count(F.lit(1)).alias("shared")))
    c = F.col("c") + F.coalesce("shared", F.lit(0))
    return open_.join(shared, ["item", "neighbour"], "left").select("item", "neighbour", c.alias("c"), _cosine(c).alias("score"))


def _ranked_items(enc: DataFrame, big: DataFrame, k: int, heavy_items: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows (user_id, d, heavy, offered, e) and items (e, item, n, h), with e rising with (n, item).

    e is even for an item whose pairs are all counted: one that no heavy user holds, or one of the k + 1 least
    of those that the same heavy users hold (``offered``).
    """
    rows = enc.join(big, "user_id", "left")
    heavy = F.coalesce(F.col("d") > heavy_items, F.lit(False)) if heavy_items else F.lit(False)
    rows = rows.withColumn("heavy", heavy)
    sets = [F.bit_xor(F.when(F.col("heavy"), F.xxhash64("user_id", F.lit(seed)))).alias(f"s{seed}") for seed in (0, 1)]
    items = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.count_if("heavy").alias("h"), *sets)
    items = cut_lineage(_numbered(items, ("n", "item")), "similarity-ranked")
    if heavy_items:
        first = F.row_number().over(Window.partitionBy("s0", "s1", "h").orderBy("iid"))
        offered = items.where("h > 0").withColumn("r", first).where(F.col("r") <= k + 1).select("iid", F.lit(True).alias("offered"))
        items = items.join(offered, "iid", "left").withColumn("offered", F.coalesce("offered", F.lit(False)))
    else:
        items = items.withColumn("offered", F.lit(False))
    unsure = (F.col("h") > 0) & ~F.col("offered")
    items = cut_lineage(items.select((2 * F.col("iid") + unsure.cast("bigint")).alias("e"), "item", "n", "h", "offered"), "similarity-ranked")
    return rows.join(items.select("item", "e", "offered"), "item").select("user_id", "d", "heavy", "offered", "e"), items.drop("offered")


def _lower(own: str, other: str) -> Column:
    """For each x of ``own``, the members of ``other`` below it."""
    return F.transform(own, lambda x: F.struct(x.alias("x"), F.filter(other, lambda y: y < x).alias("ys")))


def _partners(lists: DataFrame, rows: DataFrame, chunk_items: int, has_heavy: bool, multi: bool) -> DataFrame:
    """(x, ys, early): with each user's item x the user's items below it, in arrays of one chunk.

    ``early``: x is among the first k + 1 of the user's items. Of heavy users only pairs with an offered item are made,
    each once: blocks (user, a, b) of a chunk of their items and one of their offered items.
    """
    early = F.coalesce(F.col("x") <= F.col("till"), F.lit(True)).alias("early")
    light = lists.where(~F.col("heavy"))
    made = light.select("es", "till", F.posexplode("es").alias("p", "x")).select("x", F.slice("es", 1, F.col("p")).alias("ys"), early)
    if multi:
        other = F.explode(F.sequence(F.lit(0), F.col("nc") - 1)).alias("other")
        keyed = light.where("nc > 1").select("user_id", "till", "chunk", "es", other)
        a = keyed.where("chunk < other").select("user_id", "till", F.col("chunk").alias("a"), F.col("other").alias("b"), F.col("es").alias("xa"))
        b = keyed.where("chunk > other").select("user_id", F.col("other").alias("a"), F.col("chunk").alias("b"), F.col("es").alias("xb"))
        across = a.join(b, ["user_id", "a", "b"]).select("till", F.inline(F.concat(_lower("xa", "xb"), _lower("xb", "xa"))))
        made = made.unionByName(across.select("x", "ys", early))
    if has_heavy:
        offers = rows.where("heavy AND offered").select("user_id", "e")
        nb = offers.groupBy("user_id").agg(F.ceil(F.count(F.lit(1)) / chunk_items).cast("int").alias("nb"))
        b = offers.join(nb, "user_id").groupBy("user_id", F.pmod(F.xxhash64("e", F.lit(2)), F.col("nb")).cast("int").alias("b")).agg(F.collect_list("e").alias("of"))
        a = lists.where("heavy").join(nb, "user_id").select("user_id", "till", F.col("chunk").alias("a"), "es", "rest", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"))
        chunks = lists.where("heavy").select("user_id", "nc").distinct()
        b = b.join(chunks, "user_id").select("user_id", F.explode(F.sequence(F.lit(0), F.col("nc") - 1)).alias("a"), "b", "of")
        met = a.join(b, ["user_id", "a", "b"]).select("till", F.inline(F.concat(_lower("es", "of"), _lower("of", "rest"))))
        made = made.unionByName(met.select("x", "ys", early))
    return made.where(F.size("ys") > 0)


def _dealt(made: DataFrame, items: DataFrame, tasks: int) -> tuple[DataFrame, list[str]]:
    """``made`` dealt by x, or with hubs by (x, s), and these keys: an item of up to ``HUB_USERS`` users in one slice, twice as many slices for twice the users."""
    bounds = [F.min(F.when(F.col("n") > HUB_USERS << t, F.col("e"))).alias(f"t{t}") for t in range(HUB_LEVELS)]
    firsts = [e for e in items.agg(*bounds).first() if e is not None]
    if not firsts:
        return made.repartition(tasks, "x"), ["x"]  # a constant s would be folded out of the keys, and cost a second shuffle
    slices = F.lit(1)
    for t, e in enumerate(firsts):
        slices = F.when(F.col("x") >= e, 2 << t).otherwise(slices)
    made = made.withColumn("slices", slices)
    plain = made.where("slices = 1").select("x", F.lit(0).cast("bigint").alias("s"), "ys", "early")
    cut = (made.where("slices > 1").select("x", "ys", "early", "slices", F.explode(F.expr("array_distinct(transform(ys, y -> pmod(xxhash64(y), slices)))")).alias("s"))
           .select("x", "s", F.expr("filter(ys, y -> pmod(xxhash64(y), slices) = s)").alias("ys"), "early"))
    return plain.unionByName(cut).repartition(tasks, "x", "s"), ["x", "s"]


def _top_k_by_item(enc: DataFrame, dictionary: DataFrame, k: int, chunk_items: int, heavy_items: int) -> DataFrame:
    """``similarity_top_k`` of many items: a pair moves as one number in an array, and few counted pairs move at all.

    Items are numbered by (degree, id). A user's items below x go to x as an array, one shuffle dealt by x; pairs are
    counted where they arrive. Of neighbours with equal c the least numbers score best, so x keeps k below it for each c.
    In the other direction (x as a neighbour of a lower y) a pair counted once is sent only if x is ``early``:
    otherwise that user has k more items below x, all of them better neighbours of y. Pairs of two unsure items (see
    ``_ranked_items``) may share heavy users that were not met; they are all kept, and those whose best possible score
    reaches the item's k-th known score are counted through the holdings.
    """
    big = _big_users(enc, min(chunk_items, heavy_items))
    has_heavy = not big.where(F.col("d") > heavy_items).isEmpty()
    rows, items = _ranked_items(enc, big, k, heavy_items if has_heavy else None)
    kind = "int" if items.agg(F.max("e")).first()[0] < (1 << 31) - 1 else "bigint"
    rows = rows.withColumn("e", F.col("e").cast(kind))
    if has_heavy:
        rows = cut_lineage(rows, "similarity-rows")
    nc = F.coalesce(F.ceil(F.col("d") / F.lit(chunk_items)).cast("int"), F.lit(1))
    chunk = F.pmod(F.xxhash64("e"), nc).cast("int")
    rest = [F.collect_list(F.when(~F.col("offered"), F.col("e"))).alias("rest")] if has_heavy else []
    lists = rows.groupBy("user_id", chunk.alias("chunk"), nc.alias("nc"), "heavy").agg(F.array_sort(F.collect_list("e")).alias("es"), *rest)
    lists = cut_lineage(lists, "similarity-lists")
    multi = not big.where((F.col("d") > chunk_items) & (F.col("d") <= heavy_items)).isEmpty()
    till = F.get("es", F.lit(k))
    if multi or has_heavy:
        firsts = lists.where("nc > 1").groupBy("user_id").agg(F.get(F.array_sort(F.flatten(F.collect_list(F.slice("es", 1, k + 1)))), F.lit(k)).alias("of_all"))
        lists = lists.join(firsts, "user_id", "left").withColumn("till", F.when(F.col("nc") > 1, F.col("of_all")).otherwise(till))
    else:
        lists = lists.withColumn("till", till)
    spark, size = enc.sparkSession, F.size("es").cast("double")
    pairs = lists.agg(F.sum(size * F.greatest(size, F.col("nc") * size) / 2)).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(pairs) // PAIRS_A_TASK))
    met, dealt_by = _dealt(_partners(lists, rows, chunk_items, has_heavy, multi), items, tasks)
    counted = met.select(*dealt_by, "early", F.explode("ys").alias("y")).groupBy(*dealt_by, "y").agg(
        F.count(F.lit(1)).alias("c"), F.max("early").alias("early"))
    place = F.row_number().over(Window.partitionBy(*dealt_by, "c").orderBy("y"))
    unsure = (F.col("x") % 2 == 1) & (F.col("y") % 2 == 1) if has_heavy else F.lit(False)
    down, up = (F.col("place") <= k) | unsure, F.col("early") | (F.col("c") > 1) | unsure
    kept = counted.withColumn("place", place).select("x", "y", "c", down.alias("down"), up.alias("up"), unsure.alias("unsure")).where("down OR up")
    kept = cut_lineage(kept, "similarity-kept-pairs")
    ends = [F.when(F.col(flag), F.struct(F.col(i).cast("bigint").alias("e"), F.col(j).cast("bigint").alias("f"), "c", "unsure"))
            for flag, i, j in (("down", "x", "y"), ("up", "y", "x"))]
    found = kept.select(F.inline(F.filter(F.array(*ends), lambda end: end.isNotNull())))
    found = (found.join(items.select(F.col("e").alias("f"), F.col("item").alias("neighbour"), F.col("n").alias("m"), F.col("h").alias("g")), "f")
             .join(items, "e").select("e", "f", "item", "neighbour", "c", "n", "m", "h", "g", "unsure"))
    if has_heavy:
        found = _with_unsure(cut_lineage(found, "similarity-found"), rows.where("heavy").select("user_id", "e"), k)
    best = _best(found.select("item", "neighbour", "c", _cosine(F.col("c")).alias("score")), k)
    return _decode(best, dictionary).select("item", "neighbour", "c", "score", "rank")


def _with_unsure(found: DataFrame, holding: DataFrame, k: int) -> DataFrame:
    """``found`` with the heavy users that unsure pairs share added to their counts; those that cannot be in a top k are left out."""
    floor = (_best(found.select("item", "neighbour", _cosine(F.col("c")).alias("score")), k).groupBy("item")
             .agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("known")).where(F.col("known") >= k).select("item", "least"))
    most = _cosine(F.col("c") + F.least("h", "g"))
    open_ = cut_lineage(found.where("unsure").join(floor, "item", "left").where(F.col("least").isNull() | (most >= F.col("least"))).drop("least"), "similarity-open")
    shared = (open_.select("e", "f").join(holding, "e").join(holding.select("user_id", F.col("e").alias("f")), ["user_id", "f"])
              .groupBy("e", "f").agg(F.count(F.lit(1)).alias("shared")))
    more = open_.join(shared, ["e", "f"], "left").withColumn("c", F.col("c") + F.coalesce("shared", F.lit(0))).select(*found.columns)
    return found.where(~F.col("unsure")).unionByName(more)


def similarity_top_k(user_items: DataFrame, k: int = R.TOP_K, chunk_items: int = DEFAULT_CHUNK_ITEMS,
                     heavy_items: int = DEFAULT_HEAVY_ITEMS, unique: bool = False) -> DataFrame:
    """(item, neighbour, c, score, rank) for the k best neighbours of every item.

    Users with at most ``heavy_items`` items contribute their pairs (chunked). Users
    above it never have all their pairs enumerated; a partner reached only through
    them scores |S_i & S_j| / sqrt(n_i n_j), S = the heavy users holding an item,
    which for a fixed i falls as n_j grows. So within a group of items of equal S the
    k+1 items with the smallest (n, id) beat every other member of the group for every
    i (a member that is also a light partner only scores higher), and only those are
    offered to the items that share a heavy user with them.

    Each neighbour then appears at most twice (light and heavy-only form), so the best
    2k rows hold the true top k; duplicates are resolved by the larger
    score, and ties go by the neighbour's number, that is by its id string. The result is
    the same whatever the two bounds are; ``unique`` says that the input has no
    repeated rows.
    """
    enc, dictionary = _keyed(user_items, unique)
    n_items = dictionary.count()
    if n_items * (n_items - 1) // 2 > FEW_PAIRS:
        return _top_k_by_item(enc, dictionary, k, chunk_items, heavy_items)
    big = _big_users(enc, min(chunk_items, heavy_items))
    has_heavy = not big.where(F.col("d") > heavy_items).isEmpty()
    rows = _with_degrees(enc, big, heavy_items if has_heavy else None)
    if has_heavy:
        rows = cut_lineage(rows, "similarity-degrees")
    lists = _lists(rows.where(F.coalesce(F.col("d") <= heavy_items, F.lit(True))), chunk_items)
    # several chunks for some user: the lists feed three branches, so write them once
    multi = not big.where((F.col("d") > chunk_items) & (F.col("d") <= heavy_items)).isEmpty()
    if multi:
        lists = cut_lineage(lists, "similarity-lists")
    light = _both_directions(_pairs(lists, multi))
    if not has_heavy:
        found = _best(light.select("item", "neighbour", "c", _cosine(F.col("c")).alias("score")), k)
        return _decode(found, dictionary).select("item", "neighbour", "c", "score", "rank")
    light = cut_lineage(light, "similarity-light")
    heavy = cut_lineage(_through_heavy_users(rows, big, dictionary, k, chunk_items, heavy_items), "similarity-heavy")
    found = _with_heavy_users(light, heavy, rows.where(F.col("d") > heavy_items), k).unionByName(heavy)
    best = _best(found, 2 * k).groupBy("item", "neighbour").agg(F.max("c").alias("c"), F.max("score").alias("score"))
    return _decode(_best(best, k), dictionary).select("item", "neighbour", "c", "score", "rank")
