"""IP-range enrichment: ip -> (region, city, isp) by a range join.

Spark has no range join strategy besides a nested loop, so the join is made an
equi-join on a coarse bucket (ip >> bits): every range is exploded into the
buckets it covers and the probe joins on (bucket) with the exact BETWEEN test as
an extra join condition. Non-overlapping ranges give at most
``#ranges + 2**(32-bits)`` dimension rows. Whether the dimension is broadcast or
both sides shuffle on the bucket is left to Spark, which goes by bytes.
A left join keeps probes without a range. Ranges that overlap, or are so wide that
their buckets are many, go through ``ip_most_specific``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

DEFAULT_BUCKET_BITS = 16
ADDRESS_BITS = 32


def bucketed_ranges(ranges: DataFrame, bits: int = DEFAULT_BUCKET_BITS) -> DataFrame:
    return ranges.withColumn(
        "bucket", F.explode(F.sequence(F.shiftright("lo", bits), F.shiftright("hi", bits))))


def ip_enrich(probe: DataFrame, ranges: DataFrame, bits: int = DEFAULT_BUCKET_BITS, how: str = "left") -> DataFrame:
    dim = bucketed_ranges(ranges, bits).select(
        F.col("bucket").alias("d_bucket"), "lo", "hi", "region", "city", "isp")
    p = probe.withColumn("p_bucket", F.shiftright("ip", bits))
    cond = (F.col("p_bucket") == F.col("d_bucket")) & F.col("ip").between(F.col("lo"), F.col("hi"))
    return p.join(dim, cond, how).select("id", "ip", "region", "city", "isp")


def prefixes(ranges: DataFrame, width: int = ADDRESS_BITS) -> DataFrame:
    """ranges with (k, prefix): the aligned blocks of ``2**k`` addresses, from prefix * 2**k, that make up each range.

    A range of any width has at most two blocks of each size. At level k it holds the whole blocks from
    ceil(lo / 2**k) to before floor((hi + 1) / 2**k); the first is no half of a larger block if its number is odd, and
    the one after the last likewise. Ranges are cut to the address space; empty and null ones have no blocks.
    """
    lo, end = F.greatest("lo", F.lit(0)), F.least(F.col("hi") + 1, F.lit(1 << width))

    def at(k):
        size = F.expr(f"shiftleft(1L, {k})")
        first, after = F.floor((lo + size - 1) / size), F.floor(end / size)
        return [F.when((first < after) & (number % 2 == 1), F.struct(F.lit(k).alias("k"), (number - back).alias("prefix")))
                for number, back in ((first, 0), (after, 1))]

    blocks = F.filter(F.array(*[b for k in range(width + 1) for b in at(k)]), lambda b: b.isNotNull())
    return ranges.where("lo IS NOT NULL AND hi IS NOT NULL").select("*", F.inline(blocks))


def ip_most_specific(probe: DataFrame, ranges: DataFrame) -> DataFrame:
    """(id, ip, region, city, isp): the narrowest range that holds each probe; probes without one stay, with nulls.

    Ranges may overlap, nest and be of any width: each becomes aligned blocks (``prefixes``), of which the narrowest range of
    equal blocks is kept, and a probe looks its blocks up by equality, one for each block size that occurs (at most
    33). Ranges of equal width go by lo, then by region, city and isp, nulls first. A probe's finds are reduced where it is read,
    then by id and ip.
    """
    order = F.struct((F.col("hi") - F.col("lo")).alias("span"), "lo", *[f(c) for c in ("region", "city", "isp") for f in (_present, F.col)])
    best = F.min(F.struct(order.alias("order"), F.struct("region", "city", "isp").alias("place")))
    blocks = prefixes(ranges).groupBy("k", "prefix").agg(best.alias("best"))
    blocks = cut_lineage(blocks, "address-blocks")
    sizes = [r["k"] for r in blocks.select("k").distinct().collect()]  # at most 33
    if not sizes:
        return probe.select("id", "ip", *[F.lit(None).cast("string").alias(c) for c in ("region", "city", "isp")])
    asked = probe.select("id", "ip", F.explode(F.array(*[F.lit(k) for k in sorted(sizes)])).alias("of")).withColumn("block", F.expr("shiftright(ip, of)"))
    found = asked.join(blocks, (F.col("of") == F.col("k")) & (F.col("block") == F.col("prefix")))
    least = found.groupBy("id", "ip").agg(F.min("best").alias("best")).select(F.col("id").alias("found_id"), F.col("ip").alias("found_ip"), "best.place.*")
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("ip") == F.col("found_ip"))
    return probe.select("id", "ip").join(least, same, "left").select("id", "ip", "region", "city", "isp")


def _present(c: str):
    return F.col(c).isNotNull().alias(f"has_{c}")
