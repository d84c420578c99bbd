"""Rater sets, content-based prediction and ranked-list measures against
plain-Python restatements."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ratewise.operators import cf, content
from ratewise.operators import evaluate as EV
from ratewise.operators import ratings as R
from ratewise.sources import testdata as T

from conftest import SF_SMALL

RATING = "user_id {0}, business_id bigint, stars double"


def _ratings(seed, users, items, n, text=False):
    rng = random.Random(seed)
    cells = {(rng.randrange(users) ** 2 % users if rng.random() < .3 else rng.randrange(users), rng.randrange(items))
             for _ in range(n)}
    return [(f"u{u}" if text else u, b, float(rng.randint(1, 5))) for u, b in sorted(cells)]


# ---------------------------------------------------------------- rater sets
@pytest.mark.parametrize("bits, text, work", [(16, False, None), (3, False, None), (3, True, "40"), (1, True, "1")])
def test_overlap_counts_common_raters(spark, monkeypatch, bits, text, work):
    monkeypatch.setattr(R, "CHUNK_BITS", bits)
    rows = _ratings(5, 60, 12, 300, text)
    rows += [(rows[0][0], rows[0][1], 2.0), (None, 1, 3.0)]              # a repeated pair and a NULL id
    df = spark.createDataFrame(rows, RATING.format("string" if text else "bigint"))
    by_item = defaultdict(set)
    for u, b, _ in rows:
        if u is not None:
            by_item[b].add(u)
    chunks = R.rater_chunks(df)
    sets = defaultdict(int)
    for r in chunks.collect():
        assert r.raters == sorted(set(r.raters)) and len(r.raters) == r.n <= 1 << bits
        sets[r.business_id] += r.n
    assert sets == {b: len(us) for b, us in by_item.items()}
    pairs = [(i, j) for i in by_item for j in by_item if i <= j]
    if work:
        spark.conf.set("ratewise.skew.hotWork", work)
    try:
        got = R.rater_overlap(spark.createDataFrame(pairs, "item_i bigint, item_j bigint"), chunks)
        assert {(r.item_i, r.item_j): r.n for r in got.collect()} == {
            (i, j): len(by_item[i] & by_item[j]) for i, j in pairs}
    finally:
        spark.conf.unset("ratewise.skew.hotWork")


def test_negative_ids_and_empty_table(spark):
    df = spark.createDataFrame([(-1, 1, 1.0), (-70000, 1, 1.0), (-1, 2, 1.0)], RATING.format("bigint"))
    pairs = spark.createDataFrame([(1, 2), (1, 1)], "item_i bigint, item_j bigint")
    assert sorted(map(tuple, R.rater_overlap(pairs, R.rater_chunks(df)).collect())) == [(1, 1, 2), (1, 2, 1)]
    assert R.rater_chunks(df.limit(0)).collect() == []


def test_similarity_by_counts_is_the_same(spark):
    df = spark.createDataFrame(_ratings(9, 40, 10, 160), RATING.format("bigint"))
    pairs = spark.createDataFrame([(i, j) for i in range(10) for j in range(i, 10)], "item_i bigint, item_j bigint")
    got, want = (sorted(map(tuple, f(pairs, df).collect())) for f in (cf.item_similarity_by_counts, cf.item_similarity))
    assert [g[:4] for g in got] == [w[:4] for w in want] and {g[3] for g in got} == {"pearson", "agreement", "mean_gap"}
    assert all(abs(g[4] - w[4]) < 1e-12 for g, w in zip(got, want, strict=True))


# ---------------------------------------------------------------- content
def _brute_content(train, requests, items, k=15):
    df = defaultdict(int)
    own = {b: {x for x in (a or {}).items() if x[1] is not None} for b, a in items}
    for terms in own.values():
        for t in terms:
            df[t] += 1
    vec = {}
    for b, terms in own.items():
        w = {t: math.log(len(own) / df[t]) for t in terms if df[t] < len(own)}
        size = math.sqrt(sum(x * x for x in w.values()))
        vec[b] = {t: x / size for t, x in w.items()}
    rated, every = defaultdict(dict), defaultdict(list)
    for u, b, s in train:
        if s is not None:
            rated[u][b] = max(s, rated[u].get(b, s))
            every[u].append(s)
    out = []
    for u, b in requests:
        if u not in rated:
            out.append((u, b, 3.75, "cold_user"))
            continue
        close = []
        for n, s in rated[u].items():
            common = set(vec.get(b, {})) & set(vec.get(n, {}))
            if n != b and common:
                close.append((-round(sum(vec[b][t] * vec[n][t] for t in common), 9), n, s,
                              sum(vec[b][t] * vec[n][t] for t in common)))
        best = sorted(close)[:k]
        if best:
            out.append((u, b, sum(w * s for _, _, s, w in best) / sum(w for _, _, _, w in best), "content"))
        else:
            out.append((u, b, sum(every[u]) / len(every[u]), "user_mean"))
    return sorted(out, key=str)


def _same(got, want):
    got = sorted(map(tuple, got), key=lambda r: str(r[:2]))
    want = sorted(want, key=lambda r: str(r[:2]))
    assert [(*g[:2], g[3]) for g in got] == [(*w[:2], w[3]) for w in want]
    assert all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want, strict=True))


def test_content_on_tables(spark):
    train, req, items = (f(spark, SF_SMALL) for f in (T.train, T.requests, T.items))
    want = _brute_content([(r.user_id, r.business_id, r.stars) for r in train.collect()],
                          [(r.user_id, r.business_id) for r in req.collect()],
                          [(r.business_id, r.attributes) for r in items.collect()])
    _same(content.predict(train, req, items).collect(), want)
    assert {w[3] for w in want} == {"content", "user_mean", "cold_user"}


def test_content_edges(spark):
    items = [(1, {"a.b": "x", "c": "1"}), (2, {"a.b": "x", "c": "2"}), (3, {"c": "1"}), (4, None), (5, {}),
             (6, {"a.b": None, "c": "2"}), (7, {"all": "z"})]
    items = [(b, a if a is None else a | {"all": "z"} if b != 4 else a) for b, a in items]
    train = [(1, 1, 5.0), (1, 1, 3.0), (1, 3, 1.0), (1, 4, 2.0), (2, 5, 4.0), (2, 2, None), (3, 2, 2.0), (3, 6, 4.0)]
    req = [(1, 2), (1, 1), (1, 99), (2, 1), (3, 6), (9, 1), (1, 2)]
    got = content.predict(spark.createDataFrame(train, RATING.format("bigint")),
                          spark.createDataFrame([(*r, "x") for r in req], "user_id bigint, business_id bigint, weight string"),
                          spark.createDataFrame(items, "business_id bigint, attributes map<string,string>"))
    _same(got.collect(), _brute_content(train, req, items))
    none = spark.createDataFrame([], "business_id bigint, attributes map<string,string>")
    one = content.predict(spark.createDataFrame(train, RATING.format("bigint")),
                          spark.createDataFrame([(1, 2)], "user_id bigint, business_id bigint"), none).collect()
    assert [(r.prediction, r.source) for r in one] == [(11 / 4, "user_mean")]


def test_term_weights_are_normalised(spark):
    terms = content.item_terms(T.items(spark, SF_SMALL))
    norms = [r[1] for r in terms.groupBy("business_id").agg(F.sum(F.col("weight") * F.col("weight"))).collect()]
    assert norms and all(abs(x - 1) < 1e-12 for x in norms)


# ---------------------------------------------------------------- ranking
def _brute_ranking(pred, truth, k, least):
    best = {}
    for u, b, p in pred:
        if p is not None and not math.isnan(p):
            best[u, b] = max(p, best.get((u, b), p))
    stars = {}
    for u, b, s in truth:
        if s is not None:
            stars[u, b] = max(s, stars.get((u, b), s))
    by_user = defaultdict(list)
    for key in best.keys() & stars.keys():
        by_user[key[0]].append((key[1], best[key], stars[key]))
    out = {}
    for u, rows in by_user.items():
        ranked = sorted(rows, key=lambda r: (-round(r[1], 9), r[0]))[:k]
        ideal = sorted(rows, key=lambda r: (-r[2], r[0]))[:k]
        dcg, top = (sum((2 ** s - 1) / math.log2(i + 2) for i, (_, _, s) in enumerate(x)) for x in (ranked, ideal))
        rel = sum(s >= least for _, _, s in rows)
        hits = sum(s >= least for _, _, s in ranked)
        out[u] = (len(rows), rel, hits, hits / min(k, len(rows)), hits / rel if rel else None, dcg / top if top else None)
    return out


@pytest.mark.parametrize("k", [1, 3, 10])
def test_ranking_matches_brute_force(spark, k):
    rng = random.Random(k)
    keys = [(u, b) for u in range(12) for b in range(rng.randint(1, 15))]
    pred = [(u, b, rng.choice([1.0, 2.5, 2.5 + 1e-12, 4.0])) for u, b in keys] + [(0, 0, 9.0), (50, 1, 2.0), (51, 1, None)]
    truth = [(u, b, float(rng.randint(0, 5))) for u, b in keys if rng.random() < .9]
    truth += [(60, 1, 3.0), (51, 1, 5.0), (52, 1, 0.0), (0, 0, 5.0), (1, 0, None)]
    pred += [(52, 1, 3.0), (53, 1, float("nan"))]
    truth += [(53, 1, 4.0)]
    schema = "user_id bigint, business_id bigint, {} double"
    got = EV.ranking(spark.createDataFrame(pred, schema.format("prediction")),
                     spark.createDataFrame(truth, schema.format("stars")), k).collect()
    want = _brute_ranking(pred, truth, k, 4.0)
    assert {r.user_id for r in got} == set(want)
    for r in got:
        assert [x is None for x in r[1:]] == [x is None for x in want[r.user_id]]
        assert all(abs(x - y) < 1e-9 for x, y in zip(r[1:], want[r.user_id], strict=True) if y is not None), r


def test_empty_ranking(spark):
    pred = spark.createDataFrame([], "user_id bigint, business_id bigint, prediction double")
    truth = spark.createDataFrame([], "user_id bigint, business_id bigint, stars double")
    rows = EV.ranking(pred, truth)
    assert rows.collect() == [] and tuple(EV.ranking_summary(rows).first()) == (0, None, None, None)
