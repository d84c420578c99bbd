"""Users list only the pairs that are needed; candidates stay with their user."""
import pytest
from pyspark.sql import functions as F

from ratewise.operators import cf
from ratewise.plans import jobs as J
from test_cf_bruteforce import _joined_rows

RATING = "user_id bigint, business_id bigint, stars double"
PAIR = "item_i bigint, item_j bigint"


@pytest.fixture(scope="module")
def rated(spark):
    rows = {(u, 1 + (u * 7 + k * 3) % 120): float(1 + (u + k) % 5) for u in range(100) for k in range(40)}
    return spark.createDataFrame([(u, b, s) for (u, b), s in rows.items()], RATING).cache()


def test_other_pairs_are_not_listed(spark, rated):
    pairs = spark.createDataFrame([(i, i + 12) for i in range(1, 100, 7)], PAIR)
    rows = cf.co_rating_rows(pairs, rated, max_degree=100)
    assert 0 < _joined_rows(rows) <= 2 * rows.count()      # every two of a user's items before


def _predictions(df):
    return sorted((r.user_id, r.business_id, round(r.prediction, 9), r.source) for r in df.collect())


def test_bounds_of_marks_change_no_row(spark, rated, monkeypatch):
    train = rated.where("user_id < 30")
    req = spark.createDataFrame([(u, b) for u in range(0, 32, 5) for b in (0, 3, 50)], "user_id bigint, business_id bigint")
    want = _predictions(cf.predict(train, req))
    laid = J.prepare_cf(train)
    assert _predictions(cf.predict(laid, req)) == want
    monkeypatch.setattr(cf, "NEAR_MARKS", 1)
    monkeypatch.setattr(cf, "ASKED_MARKS", 0)
    assert _predictions(cf.predict(laid, req)) == want


def test_candidates_do_not_move(spark, rated):
    """The ranking reads the candidates where the user's ratings lie."""
    laid = J.prepare_cf(rated)
    req = spark.createDataFrame([(u, b) for u in range(0, 100, 5) for b in (3, 50)], "user_id bigint, business_id bigint")
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = cf.predict(laid, req)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    ranked = plan[plan.index("Window [row_number"):]
    assert "Exchange" not in ranked[:ranked.index("Join")], plan


def test_a_rating_without_item_counts_as_the_requested(spark):
    train = spark.createDataFrame([(1, None, 2.0), (1, 5, 4.0), (2, 6, 3.0), (2, 5, 1.0)], RATING)
    req = spark.createDataFrame([(1, 6)], "user_id bigint, business_id bigint")
    # item 6: mean 3, item 5: mean 2.5 without co-raters; the rating without item has weight 1
    want = (1.0 * 2.0 + 0.9 * 4.0) / 1.9
    assert [r.prediction for r in cf.predict(train, req).collect()] == [pytest.approx(want)]
    got = cf.predict(J.prepare_cf(train), req).select(F.round("prediction", 9).alias("p")).collect()
    assert [r.p for r in got] == [round(want, 9)]
