"""Item-CF on a hand-worked fixture: every similarity rule and every branch."""

import pytest
from pyspark.sql import functions as F

from ratewise.operators import cf

from conftest import rows

RATINGS = {
    "u1": {"A": 5, "B": 4, "C": 3, "F": 1},
    "u2": {"A": 3, "B": 2, "C": 3, "F": 3},
    "u3": {"A": 1, "B": 1, "C": 3, "F": 5},
    "u4": {"A": 4, "D": 2},
    "u5": {"A": 2, "D": 4, "E": 5},
    "u6": {"E": 1},
    "u7": {"A": 3},
}


@pytest.fixture(scope="module")
def train(spark):
    data = [(u, b, float(s)) for u, d in RATINGS.items() for b, s in d.items()]
    return spark.createDataFrame(data, "user_id string, business_id string, stars double")


@pytest.fixture(scope="module")
def weights(spark, train):
    pairs = spark.createDataFrame(
        [("A", "B"), ("A", "C"), ("A", "D"), ("A", "E"), ("B", "D"), ("A", "F")],
        "item_i string, item_j string")
    sim = cf.item_similarity(pairs, train)
    return {(i, j): (n, rule, w) for i, j, n, rule, w in rows(sim, "item_i", "item_j", "n", "rule", "weight")}


@pytest.mark.parametrize("pair,n,rule,w", [
    (("A", "B"), 3, "pearson", 0.981981),
    (("A", "C"), 3, "pearson", 0.0),        # C has zero variance
    (("A", "D"), 2, "agreement", 0.6),
    (("A", "E"), 1, "mean_gap", 1.0),
    (("B", "D"), 0, "mean_gap", 0.866667),
    (("A", "F"), 3, "pearson", -1.0),
])
def test_similarity_rules(weights, pair, n, rule, w):
    got_n, got_rule, got_w = weights[pair]
    assert (got_n, got_rule) == (n, rule)
    assert got_w == pytest.approx(w, abs=1e-6)


def test_similarity_is_symmetric(spark, train):
    fwd = spark.createDataFrame([("A", "B"), ("A", "F")], "item_i string, item_j string")
    rev = spark.createDataFrame([("B", "A"), ("F", "A")], "item_i string, item_j string")
    a = sorted(w for *_, w in rows(cf.item_similarity(fwd, train), "weight"))
    b = sorted(w for *_, w in rows(cf.item_similarity(rev, train), "weight"))
    assert a == pytest.approx(b)


@pytest.mark.parametrize("user,item,pred,source", [
    ("u9", "A", 3.75, "cold_user"),
    ("u9", "Z", 3.75, "cold_user"),       # cold user is tested before cold item
    ("u4", "Z", 3.0, "cold_item"),        # the user's mean
    ("u4", "B", 3.062377, "cf"),          # neighbours A (0.981981, 4) and D (0.866667, 2)
    ("u6", "A", 1.0, "cf"),               # one neighbour, E
    ("u7", "C", 3.75, "cf"),              # only neighbour has weight 0
    ("u7", "F", -3.0, "cf"),              # negative weight kept, no clipping
])
def test_predictions(spark, train, user, item, pred, source):
    req = spark.createDataFrame([(user, item)], "user_id string, business_id string")
    (got,) = rows(cf.predict(train, req), "prediction", "source")
    assert got[1] == source
    assert got[0] == pytest.approx(pred, abs=1e-6)


def test_one_row_per_request_including_duplicates(spark, train):
    req = spark.createDataFrame([("u4", "B"), ("u4", "B"), ("u9", "A"), ("u6", "A")],
                                "user_id string, business_id string")
    out = cf.predict(train, req)
    assert out.count() == 4
    assert out.where(F.col("user_id") == "u4").select("prediction").distinct().count() == 1


def test_rank_ties_broken_by_neighbour_id(spark):
    # U rated N01..N16; every pair (T, Nk) has no co-rater and equal means,
    # so all 16 weights are 1.0; the 15 kept are N01..N15 (all rated 3).
    data = [("U", f"N{k:02d}", 3.0) for k in range(1, 16)] + [("U", "N16", 5.0), ("V", "N16", 1.0),
                                                              ("W", "T", 3.0)]
    train = spark.createDataFrame(data, "user_id string, business_id string, stars double")
    req = spark.createDataFrame([("U", "T")], "user_id string, business_id string")
    cands = cf.candidates(req, train)
    w = cf.item_similarity(cf.needed_pairs(cands), train)
    top = cf.top_neighbours(cf.weighted_candidates(cands, w))
    kept = sorted(r[0] for r in rows(top, "neighbour"))
    assert kept == [f"N{k:02d}" for k in range(1, 16)]
    (p,) = rows(cf.predict(train, req), "prediction")
    assert p[0] == pytest.approx(3.0)


def test_exclude_self_flag(spark, train):
    req = spark.createDataFrame([("u1", "A")], "user_id string, business_id string")
    with_self = rows(cf.predict(train, req), "prediction")[0][0]
    without = rows(cf.predict(train, req, exclude_self=True), "prediction")[0][0]
    assert with_self != pytest.approx(without)


def test_pearson_in_range(spark):
    from ratewise.sources import testdata as T
    from conftest import SF_SMALL
    train = T.train(spark, SF_SMALL)
    cands = cf.candidates(cf.request_status(T.requests(spark, SF_SMALL), train)
                          .where("user_mean is not null and item_mean is not null")
                          .select("user_id", "business_id").distinct(), train)
    sim = cf.item_similarity(cf.needed_pairs(cands), train)
    lo, hi = sim.where(F.col("rule") == "pearson").agg(F.min("weight"), F.max("weight")).first()
    assert lo >= -1 - 1e-9 and hi <= 1 + 1e-9
