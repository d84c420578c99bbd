"""Logical inputs of the engine, derived from the driver's parquet tables.

The engine itself reads CSV / JSON lines (``ratewise.sources.files``); the
test data is parquet, so the same logical inputs are built here as lazy
DataFrames over ``{sf_dir}/{table}.parquet``.  Every view reads only the
columns it needs, so the scans prune to a narrow ``ReadSchema``.

Ids stay integers here; nothing downstream depends on the id type.

The train/request split is a deterministic hash split that keeps every
rating: a rating is a request (held out) when its pair hash falls in the
10 % bucket, or when its user or item is one of the designated cold ones
(absent from training altogether).  All other ratings are training rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the synthetic views (shared with the SQL oracle).
HOLDOUT_BUCKETS = 10          # (user*31 + item*17) % 10 = 0 -> held out
COLD_USER_MOD, COLD_USER_REM = 50, 7   # these users have no training rows
COLD_ITEM_MOD, COLD_ITEM_REM = 40, 9   # these items have no training rows
RAW_ITEMS = 97                # items a user can rate in the raw view: part key modulo this, so pairs repeat
RAW_USERS, RAW_STEP = 150, 10 # each block of so many users rates items so many ids further on


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, business_id, stars)``: one star rating per customer/part.

    Lines are joined to their order's customer; quantity 1-50 maps to 1-5
    stars; a pair bought several times keeps its highest rating.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    stars = (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("business_id"))
            .agg(F.max(stars).alias("stars")))


def is_request(user: Column | None = None, item: Column | None = None) -> Column:
    u = F.col("user_id") if user is None else user
    b = F.col("business_id") if item is None else item
    return (((u * 31 + b * 17) % HOLDOUT_BUCKETS == 0)
            | (u % COLD_USER_MOD == COLD_USER_REM)
            | (b % COLD_ITEM_MOD == COLD_ITEM_REM))


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings(spark, sf_dir).where(~is_request())


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs to score; ``stars`` is kept as the truth for evaluation."""
    return ratings(spark, sf_dir).where(is_request())


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per line item, repeated pairs included; ``held`` marks a
    tenth of the lines, whatever their pair.  A user rates among ``RAW_ITEMS``
    items, which overlap with those of neighbouring blocks of users, so pairs
    repeat at every size and the number of items grows with that of the users."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.expr(f"o_custkey div {RAW_USERS} * {RAW_STEP} + l_partkey % {RAW_ITEMS}").alias("business_id"),
        (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double").alias("stars"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 10 == 0).alias("held"))


def train_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows with repeated (user, item) pairs of different values."""
    return _raw_lines(spark, sf_dir).where("not held").drop("held")


def requests_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct pairs, many of which also have training rows."""
    return _raw_lines(spark, sf_dir).where("held").select("user_id", "business_id").distinct()


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rating pairs with a learnable star value (model-quality tests)."""
    r = ratings(spark, sf_dir).select("user_id", "business_id")
    return r.withColumn(
        "stars", (F.lit(1.0) + ((F.col("user_id") % 5) + (F.col("business_id") % 5)) / 2.0).cast("double"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(business_id, stars, review_count, latitude, attributes)``.

    ``attributes`` is a string map; NULL for every 7th part.  Keys ``type``,
    ``colour`` and ``noun`` have few values, ``brand`` and ``size`` too many,
    ``rare`` is present on too few items.
    """
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type",
                                            "p_size", "p_retailprice")
    counts = (table(spark, sf_dir, "lineitem").groupBy("l_partkey")
              .agg(F.count(F.lit(1)).alias("n_lines")))
    words = F.split(F.col("p_name"), " ")
    entries = F.array(
        F.struct(F.lit("type").alias("key"), F.col("p_type").alias("value")),
        F.struct(F.lit("colour").alias("key"), words.getItem(0).alias("value")),
        F.struct(F.lit("noun").alias("key"), words.getItem(1).alias("value")),
        F.struct(F.lit("brand").alias("key"), F.col("p_brand").alias("value")),
        F.struct(F.lit("size").alias("key"), F.col("p_size").cast("string").alias("value")),
        F.struct(F.lit("rare").alias("key"),
                 F.when(F.col("p_partkey") % 10 == 1, F.lit("yes")).alias("value")),
    )
    attributes = F.when(
        F.col("p_partkey") % 7 != 0,
        F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())))
    return (p.join(counts, p.p_partkey == counts.l_partkey, "left")
            .select(F.col("p_partkey").alias("business_id"),
                    (F.lit(1.0) + (F.col("p_partkey") * 7 % 9) / 2.0).alias("stars"),
                    F.coalesce(F.col("n_lines"), F.lit(0)).cast("long").alias("review_count"),
                    F.col("p_retailprice").alias("latitude"),
                    attributes.alias("attributes")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User records with the eleven fields the feature model reads."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    per_cust = (o.groupBy("o_custkey")
                .agg(F.count(F.lit(1)).alias("n_orders"),
                     # distinct order years: a bounded set (calendar years)
                     F.array_join(F.array_sort(F.collect_set(F.year("o_orderdate").cast("string"))),
                                  ",").alias("years")))
    k = F.col("c_custkey")
    elite = (F.when(k % 5 == 0, F.lit("None")).when(k % 5 == 1, F.lit(""))
             .otherwise(F.coalesce(F.col("years"), F.lit("None"))))
    friends = F.when(k % 6 == 0, F.lit("None")).otherwise(
        F.expr("substr('1,2,3,4,5', 1, 2 * (c_custkey % 6) - 1)"))
    return (c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left")
            .select(k.alias("user_id"),
                    F.coalesce(F.col("n_orders"), F.lit(0)).cast("double").alias("review_count"),
                    F.col("c_nationkey").cast("double").alias("useful"),
                    (k % 7).cast("double").alias("funny"),
                    (k % 11).cast("double").alias("cool"),
                    elite.alias("elite"),
                    friends.alias("friends"),
                    (k % 5).cast("double").alias("fans"),
                    (F.lit(1.0) + (k * 13 % 9) / 2.0).alias("average_stars"),
                    (k % 3).cast("double").alias("compliment_list"),
                    (k % 4).cast("double").alias("compliment_note")))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_discount", "l_tax")
    return li.select(F.col("l_partkey").alias("business_id"),
                     F.col("l_quantity").cast("double").alias("useful"),
                     (F.col("l_discount") * 100).alias("funny"),
                     (F.col("l_tax") * 100).alias("cool"))


def _events_of(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    from ratewise.functions.scalars import json_field
    ev = table(spark, sf_dir, "events").select("ts", "event_type", "props")
    return (ev.where(F.col("event_type") == kind)
            .withColumn("business_id", json_field("props", "k", "bigint")))


def tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_of(spark, sf_dir, "signup").select("business_id")


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_events_of(spark, sf_dir, "view")
            .select("business_id", F.col("event_type").alias("label")))


def checkins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(business_id, time map<slot,int>)``: click counts per weekday-hour slot.

    The map per item has at most 7*24 entries, so building it is bounded.
    """
    ev = _events_of(spark, sf_dir, "click")
    slot = F.concat_ws("-", F.dayofweek("ts").cast("string"), F.hour("ts").cast("string"))
    per_slot = ev.groupBy("business_id", slot.alias("slot")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    return (per_slot.groupBy("business_id")
            .agg(F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("time")))


VIEWS = {
    "ratings": ratings, "train": train, "requests": requests, "planted": planted,
    "items": items, "users": users, "reviews": reviews, "tips": tips,
    "photos": photos, "checkins": checkins,
}
