"""Sample moments, leave-one-out profiles and the fallback row."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewise.operators import profiles as P

from conftest import rows

LISTS = {
    "a": [4], "b": [4, 5], "c": [1, 4, 5], "d": [3, 3, 3], "e": [1, 4, 5, 5],
    "f": [3, 3, 3, 3, 3], "g": [1, 2, 5, 5, 3, 4],
}


def _ratings(spark, lists, key="user_id"):
    data = [(k, f"i{n}", float(v)) for k, vals in lists.items() for n, v in enumerate(vals)]
    df = spark.createDataFrame(data, "key string, other string, stars double")
    if key == "user_id":
        return df.select(F.col("key").alias("user_id"), F.col("other").alias("business_id"), "stars")
    return df.select(F.col("other").alias("user_id"), F.col("key").alias("business_id"), "stars")


def _pandas(vals):
    s = pd.Series(vals, dtype=float)
    return [s.mean(), s.std(), s.kurt(), s.skew(), s.max(), s.min()]


def _close(a, b):
    if b is None or (isinstance(b, float) and pd.isna(b)):
        return a is None
    return a == pytest.approx(b, abs=1e-9)


@pytest.mark.parametrize("key", ["user_id", "business_id"])
def test_full_profile_matches_pandas(spark, key):
    prefix = "usr" if key == "user_id" else "bns"
    prof = P.profile(_ratings(spark, LISTS, key), key, prefix)
    got = {r[0]: r[1:] for r in rows(prof, key, *P.stat_columns(prefix))}
    for k, vals in LISTS.items():
        for a, b in zip(got[k], _pandas(vals)):
            assert _close(a, b), (k, got[k], _pandas(vals))


def test_fixed_values():
    # the hand-checked rows of the fixture table
    assert _pandas([1, 4, 5, 5])[2:4] == pytest.approx([2.615468, -1.658524], abs=1e-6)
    assert _pandas([1, 2, 5, 5, 3, 4])[2:4] == pytest.approx([-1.481250, -0.382733], abs=1e-6)


@pytest.fixture(scope="module")
def fallback(spark):
    cols = P.stat_columns("usr") + P.stat_columns("bns")
    return spark.createDataFrame([tuple(float(100 + i) for i in range(12))], ", ".join(f"{c} double" for c in cols))


def test_leave_one_out_train_side(spark, fallback):
    # user u: ratings 1 4 5 5 on items i0..i3; user w: single rating on i9
    data = [("u", "i0", 1.0), ("u", "i1", 4.0), ("u", "i2", 5.0), ("u", "i3", 5.0), ("w", "i9", 2.0)]
    r = spark.createDataFrame(data, "user_id string, business_id string, stars double")
    out = P.loo_features(r, r, fallback, own_value="stars", keep=("stars",))
    got = {(u, b): vals for u, b, *vals in rows(out, "user_id", "business_id", *P.stat_columns("usr"))}
    # removing one 5 leaves 1 4 5 with max still 5
    for a, b in zip(got[("u", "i2")], _pandas([1, 4, 5])):
        assert _close(a, b)
    # removing 1 moves the minimum to 4
    assert got[("u", "i0")][5] == 4.0
    for a, b in zip(got[("u", "i0")], _pandas([4, 5, 5])):
        assert _close(a, b)
    # removing the only value gives the fallback row
    assert got[("w", "i9")] == [100.0, 101.0, 102.0, 103.0, 104.0, 105.0]


def test_leave_one_out_request_side(spark, fallback):
    data = [("u", "i0", 1.0), ("u", "i1", 4.0), ("v", "i1", 2.0)]
    r = spark.createDataFrame(data, "user_id string, business_id string, stars double")
    req = spark.createDataFrame([("u", "i1"), ("u", "i7"), ("z", "i1")], "user_id string, business_id string")
    out = P.loo_features(req, r, fallback, own_value=None)
    got = {(u, b): (ua, ba) for u, b, ua, ba in rows(out, "user_id", "business_id", "usr_avg", "bns_avg")}
    assert got[("u", "i1")] == (1.0, 2.0)      # own rating excluded on both sides
    assert got[("u", "i7")] == (2.5, 106.0)    # unknown item -> item fallback
    assert got[("z", "i1")] == (100.0, 3.0)    # unknown user -> user fallback


def test_request_side_with_repeated_pairs(spark, fallback):
    """All rows of the pair go, whatever their values."""
    data = [("u1", "A", 5.0), ("u1", "A", 1.0), ("u1", "B", 3.0), ("u2", "A", 4.0)]
    r = spark.createDataFrame(data, "user_id string, business_id string, stars double")
    req = spark.createDataFrame([("u1", "A")], "user_id string, business_id string")
    (row,) = P.loo_features(req, r, fallback, own_value=None).collect()
    assert (row.usr_avg, row.usr_min, row.usr_max) == (3.0, 3.0, 3.0)
    assert (row.bns_avg, row.bns_min, row.bns_max) == (4.0, 4.0, 4.0)


def test_null_ratings_are_left_out(spark, fallback):
    data = [("u1", "A", 5.0), ("u1", "B", None), ("u1", "C", 2.0)]
    r = spark.createDataFrame(data, "user_id string, business_id string, stars double")
    out = P.loo_features(r, r, fallback, own_value="stars")
    got = {b: v for b, v in rows(out, "business_id", "usr_avg")}
    assert got == {"A": 2.0, "B": 3.5, "C": 5.0}


def test_global_profile(spark):
    users = spark.createDataFrame([(float(v),) for v in [1, 4, 5, 5]], "average_stars double")
    items = spark.createDataFrame([(float(v),) for v in [3, 3, 3]], "stars double")
    (row,) = P.global_profile(users, items).collect()
    exp = _pandas([1, 4, 5, 5])
    assert [row.usr_avg, row.usr_std, row.usr_kurt, row.usr_skew] == pytest.approx(exp[:4])
    assert (row.usr_max, row.usr_min, row.bns_max, row.bns_min) == (5.0, 1.0, 5.0, 1.0)
    assert (row.bns_std, row.bns_skew, row.bns_kurt) == (0.0, 0.0, None)
