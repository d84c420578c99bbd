"""What item-CF moves: no rater set with a pair, each pair once to its co-ratings,
the requests read once."""
import os

import pytest

from ratewise.operators import cf
from ratewise.operators import ratings as R
from ratewise.plans import jobs as J
from ratewise.session import store

RATING = "user_id bigint, business_id bigint, stars double"
PAIR = "item_i bigint, item_j bigint"


def _train(spark):
    return spark.createDataFrame([(u, b, float(1 + (u * b) % 5)) for u in range(30) for b in range(12)
                                  if (u * 7 + b * 3) % 4], RATING)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _without_broadcast(spark, fn):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        return fn()
    finally:
        spark.conf.set(key, old)


def test_no_rater_set_travels_with_a_pair(spark):
    train = store(_train(spark), "train")
    chunks = store(R.rater_chunks(train), "chunks")
    pairs = [(i, j) for i in range(13) for j in range(13)] + [(None, 1), (2, None), (3, 99)]   # in either order
    got = R.rater_overlap(spark.createDataFrame(pairs, PAIR), chunks)
    assert "array_intersect" not in _plan(got)
    by = {}
    for r in train.collect():
        by.setdefault(r.business_id, set()).add(r.user_id)
    assert sorted(map(str, got.collect())) == sorted(
        f"Row(item_i={i}, item_j={j}, n={len(by.get(i, set()) & by.get(j, set()))})" for i, j in pairs)


def test_a_pair_moves_once_to_its_co_ratings(spark):
    train = store(_train(spark), "train")
    pairs = store(spark.createDataFrame([(i, j) for i in range(13) for j in range(i, 13)], PAIR), "pairs")
    plan = _without_broadcast(spark, lambda: _plan(cf.pair_stats(pairs, train, R.item_means(train))))
    assert sum("Exchange hashpartitioning(item_i" in x and "item_j" in x.split("Exchange")[1].split("REQUIRE")[0]
               for x in plan.splitlines()) <= 2, plan
    got = {(r.item_i, r.item_j): (r.n, r.sad) for r in cf.pair_stats(pairs, train, R.item_means(train)).collect()}
    stars = {(r.user_id, r.business_id): r.stars for r in train.collect()}
    for i in range(12):
        for j in range(i, 12):
            both = [abs(stars[u, i] - stars[u, j]) for u in range(30) if (u, i) in stars and (u, j) in stars]
            assert got.pop((i, j)) == (len(both), sum(both))
    assert not got                                       # item 12 has no mean


def test_requests_are_read_once(spark):
    laid = J.prepare_cf(_train(spark))
    req = store(spark.createDataFrame([(u, b) for u in range(32) for b in range(0, 13, 3)],
                                      "user_id bigint, business_id bigint"), "asked")
    assert "asked-" not in _plan(cf.predict(laid, req))   # the plan reads the written status alone


def test_candidates_keep_their_columns(spark):
    cands = spark.createDataFrame([(1, 5, 2, 4.0), (1, 2, 5, 3.0), (1, 2, 2, 1.0), (1, 7, 8, 1.0)],
                                  "user_id bigint, business_id bigint, neighbour bigint, rating double")
    weights = spark.createDataFrame([(2, 5, 0.5), (2, 2, 1.0)], PAIR + ", weight double")
    got = cf.weighted_candidates(cands, weights)
    assert got.columns == ["user_id", "business_id", "neighbour", "rating", "weight"]
    assert sorted(map(tuple, got.collect())) == [(1, 2, 2, 1.0, 1.0), (1, 2, 5, 3.0, 0.5), (1, 5, 2, 4.0, 0.5)]


def test_a_written_training_table_is_not_written_again(spark):
    ratings = store(_train(spark), "ratings")
    req = spark.createDataFrame([(u, b) for u in range(32) for b in range(13)], "user_id bigint, business_id bigint")
    folder = ratings.inputFiles()[0].rsplit("/", 2)[0].removeprefix("file:")
    before = set(os.listdir(folder))
    got = J.item_cf(ratings, req, written=True)
    assert not [x for x in set(os.listdir(folder)) - before if x.startswith("train-")]
    assert sorted(map(str, got.collect())) == sorted(map(str, J.item_cf(ratings, req).collect()))


@pytest.mark.parametrize("expand", ["1", "500"])
def test_a_pair_is_marked_at_the_hub_that_lists_it(spark, expand):
    train = store(_train(spark), "train")
    hubs = [2, 5, 9]
    asked = [(min(h, o), max(h, o), h <= o) for h in hubs for o in range(12)]      # two hubs: in either order
    pairs = spark.createDataFrame(asked, PAIR + ", _first boolean")
    hub_rows = spark.createDataFrame([(h,) for h in hubs], "business_id bigint")
    spark.conf.set(cf.EXPAND_CONF, expand)
    try:
        found = cf.co_rated(pairs, train, hub_rows)
        plain = cf.co_rated(pairs.drop("_first"), train, hub_rows)
    finally:
        spark.conf.unset(cf.EXPAND_CONF)
    assert "NOT _first" in _plan(found) and "NOT _first" not in _plan(plain)
    wanted = {x[:2] for x in asked}
    sums = [{(r.item_i, r.item_j): (r.n, r.sx, r.sy, r.sxy, r.sad) for r in df.collect() if (r.item_i, r.item_j) in wanted}
            for df in (found, plain)]
    stars = {(r.user_id, r.business_id): r.stars for r in train.collect()}
    for i, j in wanted:
        both = [(stars[u, i], stars[u, j]) for u in range(30) if (u, i) in stars and (u, j) in stars]
        exp = (len(both), sum(x for x, _ in both), sum(y for _, y in both), sum(x * y for x, y in both),
               sum(abs(x - y) for x, y in both))
        assert sums[0].get((i, j), (0, 0, 0, 0, 0)) == sums[1].get((i, j), (0, 0, 0, 0, 0)) == exp
