"""Equi-joins whose work per key is bounded: salting by the product of rows.

A key with ``l`` rows on one side and ``r`` on the other makes ``l * r`` output
rows in one task, however few input bytes it has, so neither a row count of one
side nor AQE's split by input bytes sees it.  ``salted_join`` counts both sides
per key (partial aggregation); a key whose product exceeds
``ratewise.skew.hotWork`` is split into ``ceil(l * r / hotWork)`` salts, without
an upper limit: the rows of its larger side are dealt out by a hash of their
other columns, the rows of its smaller side are copied to every salt.  Every
pair of rows still meets exactly once.  Other keys keep salt 0 and one copy.

The table of hot keys is joined like any other (AQE broadcasts it only when
its measured size is small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORK_CONF, DEFAULT_HOT_WORK = "ratewise.skew.hotWork", 20_000_000


def hot_keys(left: DataFrame, right: DataFrame, key: str, right_counts: DataFrame | None = None) -> DataFrame:
    """``(key, _salts, _left_big)`` of the keys whose product is over the bound.
    ``right_counts(key, n)`` are the rows per key of the right side, if known."""
    bound = int(left.sparkSession.conf.get(WORK_CONF, str(DEFAULT_HOT_WORK)))
    count = lambda df, name: df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    known = count(right, "_r") if right_counts is None else right_counts.select(key, F.col("n").alias("_r"))
    both = count(left, "_l").join(known, key)
    work = F.col("_l").cast("double") * F.col("_r")
    return both.where(work > bound).select(
        key, F.ceil(work / bound).cast("long").alias("_salts"), (F.col("_l") >= F.col("_r")).alias("_left_big"))


def _salt(df: DataFrame, hot: DataFrame, key: str, left: bool) -> DataFrame:
    joined = df.join(hot, key, "left")
    spread = F.pmod(F.xxhash64(*[c for c in df.columns if c != key]), F.col("_salts"))
    big = F.col("_left_big") if left else ~F.col("_left_big")
    salts = (F.when(F.col("_salts").isNull(), F.array(F.lit(0).cast("long")))
             .when(big, F.array(spread)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)))
    return joined.withColumn("_salt", F.explode(salts)).drop("_salts", "_left_big")


def salted_join(left: DataFrame, right: DataFrame, key: str, right_counts: DataFrame | None = None) -> DataFrame:
    """Inner join on ``key`` (the other columns have different names).  With
    ``right_counts`` it is looked first whether any key is hot (a count of the left
    side's keys): if none is, the join is on the key alone, so that a right side
    bucketed by it needs no exchange."""
    hot = hot_keys(left, right, key, right_counts)
    if right_counts is not None and hot.isEmpty():
        return left.join(right, key)
    return _salt(left, hot, key, True).join(_salt(right, hot, key, False), [key, "_salt"]).drop("_salt")
