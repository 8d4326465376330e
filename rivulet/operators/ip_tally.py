"""Count addresses per listed address range, whatever the ranges' widths.

A range is cut into the aligned blocks it is made of: at most two of each size
2^level, 62 in all, and one for the whole space.  ``ip BETWEEN lo AND hi`` then is an
equi-join on (level, prefix).  Addresses are counted by the smallest block in use
before anything else happens to them (a partial aggregate in every task, so a
frequent address is one row a task), and only these counts meet the blocks.  The
blocks go to the counts, by broadcast or, of very many ranges, by a merge join; the
counts, a row per different address and level, are never broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.ipv4 import IP_RANGES, int_to_ipv4

# signed addresses moved to 0..2^32-1: keeps their order and the blocks' borders
_ZERO = 1 << 31
SENT = 100_000  # most blocks that are broadcast


def _range_table(spark: SparkSession, ranges: DataFrame | Sequence[tuple[int, int]]) -> DataFrame:
    if not isinstance(ranges, DataFrame):
        ranges = spark.createDataFrame([(int(lo), int(hi)) for lo, hi in ranges], "lo int, hi int")
    return ranges.select(F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi")).distinct()


def range_blocks(spark: SparkSession, ranges: DataFrame | Sequence[tuple[int, int]] = IP_RANGES) -> DataFrame:
    """``(lo, hi, level, prefix)``: the blocks of 2^level addresses that make up each range
    ``lo..hi`` (signed, both ends included); ranges with ``lo > hi`` have none.  At
    every level the blocks between the rounded ends are whole; an odd one at either
    end has no place in a block of the next level."""
    ends = _range_table(spark, ranges).where("lo <= hi").select(
        "lo", "hi", (F.col("lo").cast("long") + _ZERO).alias("a"), (F.col("hi").cast("long") + _ZERO + 1).alias("b"),
        F.explode(F.sequence(F.lit(0), F.lit(32))).alias("level"),
    )
    rounded = ends.withColumn("size", F.expr("shiftleft(1L, level)")).select(
        "lo", "hi", "level", F.expr("shiftright(a + size - 1, level)").alias("first"), F.expr("shiftright(b, level)").alias("end")
    )
    odd = F.array(
        F.when(F.col("first") % 2 == 1, F.col("first")),
        F.when(F.col("end") % 2 == 1, F.col("end") - 1),
    )
    blocks = rounded.where("first < end").withColumn("prefix", F.explode(F.array_compact(odd)))
    return blocks.select("lo", "hi", "level", "prefix")


def tally(df: DataFrame, ip_col: str, ranges: DataFrame | Sequence[tuple[int, int]] = IP_RANGES) -> DataFrame:
    """``(lo, hi, total)`` for every range that holds at least one address.  Ranges may
    overlap; an address counts in each.  NULL addresses count in none."""
    blocks = range_blocks(df.sparkSession, ranges)
    # at most 33 rows
    sizes = {r["level"]: r["count"] for r in blocks.groupBy("level").count().collect()}
    levels = sorted(sizes)
    if not levels:
        return blocks.select("lo", "hi", F.lit(0).cast("long").alias("total")).limit(0)
    least = levels[0]
    place = F.shiftright(F.col(ip_col).cast("int").cast("long") + _ZERO, least)
    counts = df.where(F.col(ip_col).cast("int").isNotNull()).groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n"))
    at = F.array(*(F.struct(F.lit(k).alias("level"), F.shiftright("place", k - least).alias("prefix")) for k in levels))
    placed = counts.select("n", F.explode(at).alias("at")).select("n", "at.level", "at.prefix")
    # Spark would choose the counts to broadcast: it takes a row for one row after explode
    if sum(sizes.values()) <= SENT:
        blocks = F.broadcast(blocks)
    else:
        placed = placed.groupBy("level", "prefix").agg(F.sum("n").alias("n")).hint("merge")
    return placed.join(blocks, ["level", "prefix"]).groupBy("lo", "hi").agg(F.sum("n").alias("total"))


def tally_ranges(df: DataFrame, ip_col: str, ranges: DataFrame | Sequence[tuple[int, int]] = IP_RANGES) -> DataFrame:
    """``(range_start, total)``, the range by its dotted first address."""
    return tally(df, ip_col, ranges).select(int_to_ipv4("lo").alias("range_start"), "total")
