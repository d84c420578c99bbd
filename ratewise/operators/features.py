"""Entity feature tables and the feature merge.

Every item-side table is keyed by ``business_id`` and every user-side table
by ``user_id``, each built with one partial aggregation (map-side combine).
The merge joins all item tables to each other first (small, item-keyed).  The
(large) pair frame takes the user table where its user statistics are joined and
the combined item table where those of its items are, so it is shuffled once per
key, not once per table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.functions.scalars import map_size, packed_list_len
from ratewise.operators.encode import named

USER, ITEM = "user_id", "business_id"

# Column names of the feature frame (fixed: they name model inputs).
ITEM_BASICS = ("bus_stars", "review_cnt", "latitude")
USER_FIELDS = ("useful", "funny", "cool", "elite", "friends", "fans", "average_stars",
               "compliment_list", "compliment_note", "review_count")
VECTOR8 = ("review_useful", "review_funny", "review_cool", "user_avg_stars",
           "user_review_count", "user_fans", "item_stars", "item_review_count")


def review_means(reviews: DataFrame) -> DataFrame:
    """Mean useful / funny / cool of an item's reviews."""
    return reviews.groupBy(ITEM).agg(
        F.avg(F.col("useful").cast("double")).alias("review_useful"),
        F.avg(F.col("funny").cast("double")).alias("review_funny"),
        F.avg(F.col("cool").cast("double")).alias("review_cool"))


def tip_counts(tips: DataFrame) -> DataFrame:
    """Number of tips per item (named ``likes`` as in the feature frame)."""
    return tips.groupBy(ITEM).agg(F.count(F.lit(1)).cast("long").alias("likes"))


def photo_counts(photos: DataFrame) -> DataFrame:
    """Number of photos per item (named ``labels``)."""
    return photos.groupBy(ITEM).agg(F.count(F.lit(1)).cast("long").alias("labels"))


def checkin_slots(checkins: DataFrame) -> DataFrame:
    """Number of check-in time slots per item (``customers``): the map's
    size, not the sum of its counts.  One record per item is expected; if an
    item has several, their slot counts add up."""
    return checkins.groupBy(ITEM).agg(F.sum(map_size("time")).cast("long").alias("customers"))


def item_basics(items: DataFrame) -> DataFrame:
    return items.select(ITEM, F.col("stars").cast("double").alias("bus_stars"),
                        F.col("review_count").cast("double").alias("review_cnt"),
                        F.col("latitude").cast("double").alias("latitude"))


def relevant_users(users: DataFrame, train: DataFrame, requests: DataFrame) -> DataFrame:
    """Users that appear in the training ratings or in the requests."""
    ids = train.select(USER).union(requests.select(USER))
    return users.join(ids, USER, "left_semi")


def user_features(users: DataFrame) -> DataFrame:
    """The user fields of the feature frame; packed lists become lengths."""
    cols = [F.col(c).cast("double").alias(c) for c in USER_FIELDS if c not in ("elite", "friends")]
    return users.select(USER, packed_list_len("elite").alias("elite"),
                        packed_list_len("friends").alias("friends"), *cols).select(USER, *USER_FIELDS)


def feature_vector8(pairs: DataFrame, reviews: DataFrame, users: DataFrame,
                    items: DataFrame) -> DataFrame:
    """The 8-feature lookup of the first model: review means of the item,
    the user's average stars / review count / fans, the item's stars /
    review count.  Unknown keys give NULL."""
    rv = review_means(reviews)
    it = items.select(ITEM, F.col("stars").cast("double").alias("item_stars"),
                      F.col("review_count").cast("double").alias("item_review_count"))
    item_side = it.join(rv, ITEM, "full")
    us = users.select(USER, F.col("average_stars").cast("double").alias("user_avg_stars"),
                      F.col("review_count").cast("double").alias("user_review_count"),
                      F.col("fans").cast("double").alias("user_fans"))
    keep = [c for c in pairs.columns if c not in (USER, ITEM)]
    return (pairs.join(item_side, ITEM, "left").join(us, USER, "left")
            .select(USER, ITEM, *keep, *VECTOR8))


def item_feature_table(items: DataFrame, tips: DataFrame, photos: DataFrame,
                       checkins: DataFrame, attributes: DataFrame | None = None) -> DataFrame:
    """All item-keyed features in one table (item-side joins only)."""
    tables = [item_basics(items)]
    if attributes is not None:
        tables.append(attributes)
    tables += [tip_counts(tips), photo_counts(photos), checkin_slots(checkins)]
    return reduce(lambda a, b: a.join(b, ITEM, "full"), tables)


def merge_user(pairs: DataFrame, user_table: DataFrame) -> DataFrame:
    """Left-join the user table to the pair frame."""
    return pairs.join(user_table, USER, "left")


def merge_features(base: DataFrame, item_table: DataFrame, user_fields: list[str]) -> DataFrame:
    """Left-join the item feature table to the pair frame, which holds the user's
    fields already (``merge_user``); they come last."""
    own = [c for c in base.columns if c not in user_fields]
    items = [c for c in item_table.columns if c != ITEM]
    return base.join(item_table, ITEM, "left").select(*map(named, own + items + list(user_fields)))


def assert_unique(df: DataFrame, key: str, what: str) -> DataFrame:
    """``df`` itself; an error if a key occurs twice, which would multiply the
    pairs it is merged to."""
    twice = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if twice is not None:
        raise ValueError(f"{what}: {key} {twice[key]!r} occurs {twice['n']} times")
    return df


def fill_missing(df: DataFrame, fallback: DataFrame, user_fallback: bool = False,
                 exclude: tuple[str, ...] = (USER, ITEM, "y")) -> DataFrame:
    """Missing values: ``bns_*`` columns (and ``usr_*`` ones with
    ``user_fallback``) take the one-row fallback profile, every other numeric
    column takes 0.  Without ``user_fallback`` missing user statistics are 0, as
    in the original."""
    prefixes = ("bns_", "usr_") if user_fallback else ("bns_",)
    fb_cols = [c for c in fallback.columns if c.startswith(prefixes)]
    fb = fallback.select(*[F.col(c).alias(f"_fb_{c}") for c in fb_cols])
    joined = df.crossJoin(F.broadcast(fb))  # one row
    numeric = {f.name for f in df.schema.fields
               if f.dataType.typeName() in ("double", "float", "long", "integer", "short", "byte")}
    out = []
    for c in df.columns:
        if c in exclude or c not in numeric:
            out.append(named(c))
        elif c in fb_cols:
            out.append(F.coalesce(F.col(c).cast("double"), F.col(f"_fb_{c}"), F.lit(0.0)).alias(c))
        else:
            out.append(F.coalesce(named(c).cast("double"), F.lit(0.0)).alias(c))
    return joined.select(*out)
