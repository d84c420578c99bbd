"""Randomised checks of profiles and leave-one-out statistics against pandas.

300 seeded random rating lists (1-12 values, whole and half stars) are
scored in one Spark job each way; every statistic must equal pandas'
``mean/std/kurt/skew/max/min`` of the same list (leave-one-out: of the list
with one occurrence of the row's own value removed, or the fallback row).
"""

import numpy as np
import pandas as pd
import pytest

from ratewise.operators import profiles as P

STATS = ["avg", "std", "kurt", "skew", "max", "min"]


def _pandas(vals):
    s = pd.Series(vals, dtype=float)
    return [s.mean(), s.std(), s.kurt(), s.skew(), s.max(), s.min()]


def _same(a, b):
    if b is None or pd.isna(b):
        return a is None
    return a is not None and abs(a - b) <= 1e-9 * max(1.0, abs(b))


@pytest.fixture(scope="module")
def lists():
    rng = np.random.default_rng(7)
    out = {}
    for k in range(300):
        n = int(rng.integers(1, 13))
        pool = np.arange(2, 11) / 2.0 if k % 2 else np.arange(1, 6, dtype=float)
        if k % 7 == 0:
            pool = pool[:1]                      # zero variance
        out[f"u{k}"] = [float(x) for x in rng.choice(pool, size=n)]
    return out


def test_profiles_match_pandas(spark, lists):
    rows = [(u, f"i{j}", v) for u, vals in lists.items() for j, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "user_id string, business_id string, stars double")
    got = {r[0]: list(r[1:]) for r in P.user_profile(df).select(
        "user_id", *[f"usr_{s}" for s in STATS]).collect()}
    for u, vals in lists.items():
        exp = _pandas(vals)
        assert all(_same(a, b) for a, b in zip(got[u], exp)), (u, vals, got[u], exp)


def test_leave_one_out_matches_pandas(spark, lists):
    rows = [(u, f"i{j}", v) for u, vals in lists.items() for j, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "user_id string, business_id string, stars double")
    fb_cols = [f"{p}_{s}" for p in ("usr", "bns") for s in STATS]
    fb = spark.createDataFrame([tuple(-1.0 - i for i in range(12))], ", ".join(f"{c} double" for c in fb_cols))
    out = P.loo_features(df, df, fb, own_value="stars", keep=("stars",))
    got = {(r[0], r[1]): list(r[2:]) for r in out.select(
        "user_id", "business_id", *[f"usr_{s}" for s in STATS]).collect()}
    for u, vals in lists.items():
        for j, v in enumerate(vals):
            rest = list(vals)
            rest.remove(v)
            exp = _pandas(rest) if rest else [-1.0 - i for i in range(6)]
            g = got[(u, f"i{j}")]
            assert all(_same(a, b) for a, b in zip(g, exp)), (u, vals, v, g, exp)
