"""What content-based prediction moves: ratings and requests with their items' terms, no pair and no candidate."""
import pytest

from ratewise.operators import content
from ratewise.session import store
from test_sets_content_ranking import RATING, _brute_content, _ratings, _same

ITEMS = [(b, {"colour": f"c{b % 3}", "size": f"s{b % 4}", "odd": None if b % 2 else "x"} if b % 5 else None) for b in range(14)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("work", [None, "5"])
def test_no_pair_moves(spark, work):
    train = _ratings(3, 20, 14, 150)
    train += [(*train[0][:2], 5.0), (None, 1, 2.0), (1, None, 3.0), (2, 3, None)]
    asked = [(u, b) for u in range(22) for b in range(0, 15, 2)] + [(3, 2), (None, 4), (4, None)]
    rows = store(spark.createDataFrame(train, RATING.format("bigint")), "train")
    req = store(spark.createDataFrame(asked, "user_id bigint, business_id bigint"), "asked")
    items = store(spark.createDataFrame(ITEMS, "business_id bigint, attributes map<string,string>"), "items")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1"} | ({"ratewise.skew.hotWork": work} if work else {})
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = content.predict(rows, req, items)
        plan = _plan(got)
        moved = [x for x in plan.splitlines() if "Exchange" in x]
        assert not any("item_i" in x or "neighbour" in x for x in moved), moved
        result = got.collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # a NULL id takes part in no pair
    want = _brute_content([r for r in train if None not in r[:2]], [r for r in asked if None not in r], ITEMS)
    _same([r for r in result if None not in (r.user_id, r.business_id)],
          [w if w[3] != "user_mean" else w[:2] + (_mean(train, w[0]), w[3]) for w in want])
    assert {(r.user_id, r.business_id): r.source for r in result if None in (r.user_id, r.business_id)} == {
        (None, 4): "cold_user", (4, None): "user_mean"}


def _mean(train, user):
    stars = [s for u, _, s in train if u == user and s is not None]
    return sum(stars) / len(stars)
