"""Six-statistic rating profiles: full, leave-one-out, and the global fallback.

A profile of a rating list is ``avg, std, kurt, skew, max, min`` (sample
statistics, see ``ratewise.functions.moments``).  Per user and per item the
list is summarised once by count, power sums, and the two smallest / two
largest values (with multiplicity); every leave-one-out profile is then an
O(1) arithmetic update of that summary, so no list is collected and no
training row is compared with the other rows of its group.

Summaries are built in two aggregation passes over ``(key, value, count)``
(the distinct values of each group, combined map-side), so a hot user or
item never lands in one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions.moments import (central_columns, moment_columns, power_sum_aggs, prefixed,
                                       stats_from_central)

USER, ITEM, STARS = "user_id", "business_id", "stars"
USER_PREFIX, ITEM_PREFIX = "usr", "bns"
STAT_NAMES = ("avg", "std", "kurt", "skew", "max", "min")

# Fixed values of the fallback profile: max and min are the rating bounds.
FALLBACK_MAX, FALLBACK_MIN = 5.0, 1.0


def stat_columns(prefix: str) -> list[str]:
    return [f"{prefix}_{s}" for s in STAT_NAMES]


def _value_counts(ratings: DataFrame, *keys: str, value: str = STARS) -> DataFrame:
    """``(*keys, v, c)``: how often each value occurs; NULL values are left out."""
    v = F.col(value).cast("double")
    return ratings.where(v.isNotNull()).groupBy(*keys, v.alias("v")).agg(F.count(F.lit(1)).alias("c"))


def _power_sums() -> list[Column]:
    c, x = F.col("c"), F.col("v")
    return [F.sum(c).cast("long").alias("n"), F.sum(c * x).alias("s1"), F.sum(c * x * x).alias("s2"),
            F.sum(c * x * x * x).alias("s3"), F.sum(c * x * x * x * x).alias("s4")]


def summarize(ratings: DataFrame, key: str, value: str = STARS, neighbours: bool = False) -> DataFrame:
    """``key, n, s1..s4, mn, mx`` per group; with ``neighbours`` also ``mn_n``,
    the multiplicity of the minimum, and ``mn_next``, the next larger distinct
    value (NULL if none), and the same for the maximum.
    """
    vc = _value_counts(ratings, key, value=value)
    c, x = F.col("c"), F.col("v")
    base = vc.groupBy(key).agg(*_power_sums(), F.min(x).alias("mn"), F.max(x).alias("mx"),
                               F.min_by(c, x).alias("mn_n"), F.max_by(c, x).alias("mx_n"))
    if not neighbours:
        return base.drop("mn_n", "mx_n")
    ext = vc.join(base.select(key, "mn", "mx"), key).groupBy(key).agg(
        F.min(F.when(x > F.col("mn"), x)).alias("mn_next"),
        F.max(F.when(x < F.col("mx"), x)).alias("mx_next"))
    return base.join(ext, key)


def _staged_stats(df: DataFrame, keep: list[str], sides: list[tuple[str, str]],
                  fallback: bool = False) -> DataFrame:
    """Statistics in two small projections per side.

    ``sides`` lists ``(tag, prefix)``; ``df`` holds ``<tag>_n, _s1.._s4,
    _mn, _mx`` (and ``fb_<prefix>_*`` when ``fallback``).
    """
    c = lambda tag, name: F.col(f"{tag}_{name}")
    central = [col for tag, _ in sides
               for col in central_columns(c(tag, "n"), c(tag, "s1"), c(tag, "s2"), c(tag, "s3"),
                                          c(tag, "s4"), f"{tag}_c")]
    carry = [f"{tag}_{x}" for tag, _ in sides for x in ("n", "mn", "mx")]
    fb = [x for x in df.columns if x.startswith("fb_")] if fallback else []
    step = df.select(*keep, *carry, *fb, *central)
    out = []
    for tag, prefix in sides:
        m = stats_from_central(f"{tag}_c")
        n = c(tag, "n")
        m["max"] = F.when(n > 0, c(tag, "mx")).cast("double")
        m["min"] = F.when(n > 0, c(tag, "mn")).cast("double")
        for stat in STAT_NAMES:
            v = m[stat]
            if fallback:
                v = F.when(n > 0, v).otherwise(F.col(f"fb_{prefix}_{stat}"))
            out.append(v.cast("double").alias(f"{prefix}_{stat}"))
    return step.select(*keep, *out)


def profile(ratings: DataFrame, key: str, prefix: str) -> DataFrame:
    """Full profile per group: ``key, <prefix>_avg ... <prefix>_min``."""
    s = summarize(ratings, key)
    s = s.select(key, *[F.col(x).alias(f"g_{x}") for x in ("n", "s1", "s2", "s3", "s4", "mn", "mx")])
    return _staged_stats(s, [key], [("g", prefix)])


def user_profile(ratings: DataFrame) -> DataFrame:
    return profile(ratings, USER, USER_PREFIX)


def item_profile(ratings: DataFrame) -> DataFrame:
    return profile(ratings, ITEM, ITEM_PREFIX)


def global_profile(users: DataFrame, items: DataFrame) -> DataFrame:
    """One row: the fallback profile of users' ``average_stars`` and items'
    ``stars``; max and min are the fixed rating bounds."""
    def side(df, col, prefix):
        agg = df.agg(*power_sum_aggs(col))
        return agg.select(*moment_columns(F.col("n"), F.col("s1"), F.col("s2"), F.col("s3"),
                                          F.col("s4"), prefixed(prefix)),
                          F.lit(FALLBACK_MAX).alias(f"{prefix}_max"),
                          F.lit(FALLBACK_MIN).alias(f"{prefix}_min"))
    u = side(users, "average_stars", USER_PREFIX)
    b = side(items, "stars", ITEM_PREFIX)
    return u.crossJoin(b).select(*stat_columns(USER_PREFIX), *stat_columns(ITEM_PREFIX))


def _prefixed_summary(ratings: DataFrame, key: str, tag: str, neighbours: bool) -> DataFrame:
    s = summarize(ratings, key, neighbours=neighbours)
    return s.select(F.col(key), *[F.col(c).alias(f"{tag}_{c}") for c in s.columns if c != key])


def _rest_bounds(own: DataFrame, ratings: DataFrame, key: str, tag: str) -> DataFrame:
    """``(user, item, <tag>_rest_mn, <tag>_rest_mx)`` of the key's values
    without the pair's own rows, for the pairs that have some."""
    rest = (own.select(USER, ITEM).distinct().join(_value_counts(ratings, key), key)
            .join(own.select(USER, ITEM, "v", F.col("c").alias("_k")), [USER, ITEM, "v"], "left")
            .where(F.col("c") > F.coalesce(F.col("_k"), F.lit(0))))
    return rest.groupBy(USER, ITEM).agg(F.min("v").alias(f"{tag}_rest_mn"), F.max("v").alias(f"{tag}_rest_mx"))


def loo_features(pairs: DataFrame, ratings: DataFrame, fallback: DataFrame,
                 own_value: str | None = STARS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Leave-one-out profiles of each pair's user and item.

    For a training pair (``own_value`` given) one occurrence of its own rating
    is removed from both its user's and its item's list (none if it is NULL).
    For a request (``own_value=None``) all training rows of the pair, whatever
    their values, are removed.  An empty remainder takes the fallback profile
    (one row, broadcast).
    Output: ``user_id, business_id, *keep, usr_* (6), bns_* (6)``.
    """
    sides = (("us", USER, "ua"), ("bs", ITEM, "ba"))
    fb = fallback.select(*[F.col(c).alias(f"fb_{c}") for c in fallback.columns])
    p = pairs
    if own_value is None:
        wanted = pairs.select(USER, ITEM).distinct()
        own = _value_counts(ratings, USER, ITEM).join(wanted, [USER, ITEM], "left_semi")
        sums = own.groupBy(USER, ITEM).agg(*_power_sums())
        p = p.join(sums.select(USER, ITEM, *[F.col(c).alias(f"_own_{c}") for c in ("n", "s1", "s2", "s3", "s4")]),
                   [USER, ITEM], "left")
        for tag, key, _ in sides:
            p = p.join(_rest_bounds(own, ratings, key, tag), [USER, ITEM], "left")
        gone = {c: F.coalesce(F.col(f"_own_{c}"), F.lit(0)) for c in ("n", "s1", "s2", "s3", "s4")}
    else:
        v = F.col(own_value).cast("double")
        power = F.lit(1.0)
        gone = {"n": F.when(v.isNull(), 0).otherwise(1).cast("long")}
        for k in range(1, 5):
            power = power * v
            gone[f"s{k}"] = F.coalesce(power, F.lit(0.0))
    for tag, key, _ in sides:
        p = p.join(_prefixed_summary(ratings, key, tag, own_value is not None), key, "left")
    # the fallback is a single row: a broadcast nested-loop join of 1 row
    p = p.crossJoin(F.broadcast(fb))
    adjusted = []
    for s, _, tag in sides:
        c = lambda name: F.col(f"{s}_{name}")  # noqa: E731, B023
        adjusted += [F.coalesce(c("n") - gone["n"], F.lit(0)).alias(f"{tag}_n")]
        adjusted += [(c(x) - gone[x]).alias(f"{tag}_{x}") for x in ("s1", "s2", "s3", "s4")]
        if own_value is None:
            has_own = F.col("_own_n").isNotNull()
            mn = F.when(has_own, c("rest_mn")).otherwise(c("mn"))
            mx = F.when(has_own, c("rest_mx")).otherwise(c("mx"))
        else:
            mn = F.when((v == c("mn")) & (c("mn_n") == 1), c("mn_next")).otherwise(c("mn"))
            mx = F.when((v == c("mx")) & (c("mx_n") == 1), c("mx_next")).otherwise(c("mx"))
        adjusted += [mn.alias(f"{tag}_mn"), mx.alias(f"{tag}_mx")]
    keep_cols = [USER, ITEM, *keep]
    fb_cols = [x for x in p.columns if x.startswith("fb_")]
    p = p.select(*keep_cols, *fb_cols, *adjusted)
    return _staged_stats(p, keep_cols, [("ua", USER_PREFIX), ("ba", ITEM_PREFIX)], fallback=True)
