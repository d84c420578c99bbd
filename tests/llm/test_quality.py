import numpy as np
from pyspark.sql import functions as F

from ratewise.llm import quality as Q

SF = "/root/testdata/sf0.1"


def auc(y, s):
    order = np.argsort(s)
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = Q.scores(docs, Q.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    y, s = np.array([r.quality for r in got]), np.array([r.score for r in got])
    print("auc", auc(y, s), "accuracy", ((s >= 0.5) == y).mean(), "base", y.mean(), "n", len(y))
    assert len(y) > 1000 and auc(y, s) > 0.9 and ((s >= 0.5) == y).mean() > max(y.mean(), 0.9)


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    ratio = np.zeros(Q.BUCKETS)
    ratio[:20] = rng.normal(size=20)
    rows = [(np.flatnonzero(rng.random(20) < 0.4), int(rng.random() < 0.5), 1.0) for _ in range(80)]
    rows = [r for r in rows if len(r[0])]

    def loss(w):
        hinge = sum(max(0, 1 - (2 * y - 1) * Q.margin(at, ratio, w)) for at, y, _ in rows)
        return w @ w / 2 + Q.COST * hinge

    w = Q.dual_coordinate_descent(rows, ratio)
    best = loss(w)
    for _ in range(200):
        step = np.zeros_like(w)
        step[:20] = rng.normal(size=20) * 0.02
        step[-1] = rng.normal() * 0.02
        assert loss(w + step) > best - 1e-3


def test_late_rows_set_the_sigmoid_alone(spark):
    """Ratios are those of the counted rows, restated; the late rows' texts change
    neither them nor the weights."""
    docs = spark.createDataFrame([(i, f"{'GOOD' if i % 2 else 'bad##'} words {i % 7}") for i in range(200)],
                                 "doc_id bigint, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality")
    late = F.pmod(F.xxhash64(F.lit("late"), "doc_id"), F.lit(5)) == 0
    other = docs.withColumn("text", F.when(late, F.lit("quite different")).otherwise(F.col("text")))
    a, b = Q.load.__wrapped__(Q.fit(docs, labels)), Q.load.__wrapped__(Q.fit(other, labels))
    assert (a.ratio == b.ratio).all() and (a.w == b.w).all() and (a.a, a.b) != (b.a, b.b)
    counts = np.full((Q.BUCKETS, 2), Q.SMOOTH)
    for r in docs.where(~late & ~Q.held_out()).collect():
        for bucket in set(Q.features(r.text).tolist()):
            counts[bucket, r.doc_id % 2] += 1
    p = counts / counts.sum(0)
    assert np.allclose(a.ratio, np.log(p[:, 1] / p[:, 0]))


def test_edges(spark):
    rows = [(i, "GOOD words here" if i % 2 else "bad### words%%%", "clash") for i in range(60)]
    rows += [(100, None, "c"), (101, "", "c"), (102, " ", "c"), (None, "GOOD words", "c"), (1, "GOOD words here", "c"),
             (103, "x y " * 400_000, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)] + [(1, 1, 0), (2, None, 0), (None, 1, 1)],
                                   "doc_id bigint, quality int, text int")
    got = Q.scores(docs, Q.fit(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].predicted == 1 and by[2].predicted == 0 and by[None].predicted == 1
    assert {r.score for r in Q.scores(docs, Q.fit(docs, labels.limit(0))).collect()} == {0.5}
    one = Q.fit(docs, labels.withColumn("quality", F.lit(1)))
    assert {r.score for r in Q.scores(docs, one).collect()} == {1.0}
    none = docs.limit(0)
    assert Q.scores(none, Q.fit(none, labels)).collect() == []


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {tuple(r) for r in Q.scores(docs, Q.fit(docs, labels)).collect()}
    assert a == {tuple(r) for r in Q.scores(docs, Q.fit(docs, flipped)).collect()}
