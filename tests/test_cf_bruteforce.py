"""Item-CF against a plain-Python restatement, on a hot-key fixture, through
both join strategies (broadcast and shuffle with AQE skew splitting)."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ratewise.operators import cf
from ratewise.sources import testdata as T

from conftest import SF_SMALL


def brute_force(train_rows, requests, k=15):
    """Direct restatement of the rules, one request at a time."""
    by_item, by_user, r = defaultdict(set), defaultdict(set), {}
    sums = defaultdict(lambda: [0.0, 0])
    for u, b, s in train_rows:
        by_item[b].add(u)
        by_user[u].add(b)
        r[(u, b)] = s
        sums[b][0] += s
        sums[b][1] += 1
    umean = {u: sum(r[(u, b)] for b in bs) / len(bs) for u, bs in by_user.items()}
    imean = {b: t / n for b, (t, n) in sums.items()}

    def weight(b, b1):
        co = by_item[b] & by_item[b1]
        if len(co) <= 1:
            return (5 - abs(imean[b] - imean[b1])) / 5
        xs = [r[(v, b)] for v in co]
        ys = [r[(v, b1)] for v in co]
        if len(co) == 2:
            return sum((5 - abs(x - y)) / 5 for x, y in zip(xs, ys)) / 2
        mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
        num = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
        den = (sum((x - mx) ** 2 for x in xs) ** 0.5) * (sum((y - my) ** 2 for y in ys) ** 0.5)
        return num / den if den != 0 else 0.0

    out = {}
    for u, b in requests:
        if u not in by_user:
            out[(u, b)] = 3.75
        elif b not in by_item:
            out[(u, b)] = umean[u]
        else:
            ws = sorted(((round(weight(b, b1), 9), b1, r[(u, b1)]) for b1 in by_user[u]),
                        key=lambda t: (-t[0], t[1]))[:k]
            den = sum(abs(w) for w, _, _ in ws)
            out[(u, b)] = sum(w * s for w, _, s in ws) / den if den != 0 else 3.75
    return out


@pytest.fixture(scope="module")
def hot_fixture(spark):
    """sf0.001 ratings where one user holds a third of all training rows."""
    base = T.ratings(spark, SF_SMALL)
    hot = F.when(F.col("business_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    r = (base.select(hot.alias("user_id"), "business_id", "stars")
         .groupBy("user_id", "business_id").agg(F.max("stars").alias("stars")))
    train = r.where(~T.is_request() | (F.col("user_id") == -1))
    req = r.where(T.is_request() & (F.col("user_id") != -1))
    # requests of the hot user: items it did not rate
    extra = (base.select("business_id").distinct().where(F.col("business_id") % 3 != 0)
             .limit(50).select(F.lit(-1).cast("long").alias("user_id"), "business_id"))
    req = req.select("user_id", "business_id").unionByName(extra)
    return train, req


def _compare(spark, train, req, **kw):
    got = {(u, b): p for u, b, p in cf.predict(train, req, **kw)
           .select("user_id", "business_id", "prediction").collect()}
    exp = brute_force([tuple(x) for x in train.collect()],
                      [tuple(x) for x in req.select("user_id", "business_id").collect()])
    assert set(got) == set(exp)
    bad = [(key, got[key], exp[key]) for key in exp if abs(got[key] - exp[key]) > 1e-6]
    assert not bad, bad[:5]
    return len(got)


def test_hot_user(spark, hot_fixture):
    train, req = hot_fixture
    assert _compare(spark, train, req) > 50


def test_hot_user_shuffle_path_with_skew_split(spark, hot_fixture):
    train, req = hot_fixture
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert _compare(spark, train, req) > 50
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_real_views_against_brute_force(spark):
    train, req = T.train(spark, SF_SMALL), T.requests(spark, SF_SMALL)
    _compare(spark, train, req)


def test_hot_products_salted(spark, hot_fixture):
    """Each side alone is under the bound, their product is not: the hot user
    is salted, every user above three items is looked up instead of expanded,
    and results stay exact."""
    train, req = hot_fixture
    conf = {"ratewise.skew.hotWork": "1000", "ratewise.cf.expandItems": "3",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        from ratewise.operators import skew
        hot = skew.hot_keys(req.select("user_id", "business_id"), train, "user_id").collect()
        sides = [df.groupBy("user_id").count().agg({"count": "max"}).first()[0] for df in (req, train)]
        assert max(sides) <= 1000 and any(r._salts >= 2 for r in hot), (sides, hot)
        assert _compare(spark, train, req) > 50
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _joined_rows(df):
    """Rows that the joins on the user put out, from the executed plan's metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if "Join" in name and "user_id" in node.toString().split("\n")[0]:
            metric = node.metrics().get("numOutputRows")
            total += metric.get().value() if metric.isDefined() else 0
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())]
    return total


@pytest.fixture(scope="module")
def wide(spark):
    """300 users rate 40 items each; item 0 has three raters, one of whom rated
    items of their own."""
    rows = [(u, 1 + (u * 7 + k * 3) % 120, float(1 + (u + k) % 5)) for u in range(300) for k in range(40)]
    rows += [(u, 0, 4.0) for u in (1, 2, 3)]
    rows = list({(u, b): (u, b, s) for u, b, s in rows}.values())
    return spark.createDataFrame(rows, "user_id bigint, business_id bigint, stars double").cache()


def test_one_request_costs_its_own_raters(spark, wide):
    """A request for item 0 lists pairs for its three raters only, not the
    40 * 40 pairs of each of 300 users."""
    req = spark.createDataFrame([(9, 0)], "user_id bigint, business_id bigint")
    assert _compare(spark, wide, req) == 1
    mine = wide.where("user_id = 9").select(F.lit(0).cast("long").alias("item_i"), F.col("business_id").alias("item_j"))
    rows = cf.co_rating_rows(mine, wide, hubs=req.select("business_id"), max_degree=100)
    assert 0 < _joined_rows(rows) < 2000
    everyone = wide.where("business_id <> 0").select("business_id").distinct()
    others = everyone.select(F.col("business_id").alias("item_i")).crossJoin(
        everyone.select(F.col("business_id").alias("item_j"))).where("item_i <= item_j")
    assert _joined_rows(cf.co_rating_rows(others, wide, max_degree=100)) > 100_000


def test_hubs_do_not_change_the_rows(spark, wide):
    """Any choice of hubs that covers the pairs gives each co-rating once."""
    picked = [(i, j) for i in range(0, 120, 7) for j in range(i, 121, 5)]
    pairs = spark.createDataFrame(picked, "item_i bigint, item_j bigint")
    rated = {(r.user_id, r.business_id): r.stars for r in wide.collect()}
    by_item = {}
    for u, b in rated:
        by_item.setdefault(b, set()).add(u)
    want = sorted((i, j, u, rated[u, i], rated[u, j]) for i, j in picked for u in by_item[i] & by_item[j])
    both = pairs.select(F.col("item_j").alias("business_id"))
    every = pairs.select(F.explode(F.array("item_i", "item_j")).alias("business_id"))
    for hubs in (None, both, every):
        assert sorted(map(tuple, cf.co_rating_rows(pairs, wide, hubs).collect())) == want
    spark.conf.set("ratewise.cf.expandItems", "3")
    try:
        assert sorted(map(tuple, cf.co_rating_rows(pairs, wide, every).collect())) == want
    finally:
        spark.conf.unset("ratewise.cf.expandItems")


def test_needed_items_alone_are_read(spark, wide):
    """The plan cuts the ratings down to the items of the pairs before users
    list theirs; no join has a hash table that cannot be checked for size."""
    pairs = spark.createDataFrame([(0, 5)], "item_i bigint, item_j bigint")
    plan = cf.co_rating_rows(pairs, wide, max_degree=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "shuffle_hash" not in plan
    listing = next(line for line in plan.split("\n") if "Join Inner" in line and "user_id" in line)
    below = plan[plan.index(listing):]
    assert below.count("Aggregate [business_id") >= 2            # both sides meet the items of the pairs first
    assert {r.business_id for r in cf.wanted_ratings(pairs, wide).select("business_id").distinct().collect()} == {0, 5}
