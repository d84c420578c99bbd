import numpy as np
from pyspark.sql import functions as F

from ratewise.llm import language as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.predict(docs, L.fit(docs)).join(docs, "doc_id").where("held_out and lang is not null").collect()
    right = np.array([r.lang == r.lang_pred for r in got])
    score = np.array([r.score for r in got])
    assert len(got) > 250 and right.mean() >= 0.97
    assert abs(score.mean() - right.mean()) < 0.05 and score.min() >= 0 and score.max() <= 1


def test_held_out_rows_and_their_labels_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    other = docs.withColumn("lang", F.when(L.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a = {tuple(r) for r in L.predict(docs, L.fit(docs)).collect()}
    assert a == {tuple(r) for r in L.predict(docs, L.fit(other)).collect()}


def test_edges(spark):
    rows = [(i, t, l, "clash") for i, (t, l) in enumerate(
        [("der und die", "de"), ("the and of", "en")] * 30 + [(None, "en"), ("", None), ("12 +!", "de")])]
    rows += [(None, "the and", None, "c"), (7, "the of", "en", "c"), (7, "the of", "en", "c"),
             (900, "the and " * 300_000, None, "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    got = L.predict(df, L.fit(df)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (60, 61, 62)] == ["und"] * 3
    assert by[None].lang_pred == by[900].lang_pred == by[7].lang_pred == "en" and not by[None].held_out
    assert L.predict(df.limit(0), L.fit(df.limit(0))).collect() == []
    bare = df.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in L.predict(bare, L.fit(bare)).collect()} == {("und", 0.0)}


def test_pieces_of_a_long_text_count_like_the_whole(monkeypatch):
    text = "Ab cd, éf  gh 12 ij" * 50
    whole = L.counts(text)
    monkeypatch.setattr(L, "CHUNK", 997)
    assert np.abs(L.counts(text + "") - whole).sum() <= 4


def test_keep(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = L.fit(docs)
    kept = L.keep(docs, model)
    assert kept.columns == docs.columns and kept.count() >= 0.95 * docs.count()
    assert L.keep(docs.limit(3).withColumn("text", F.lit("1 2 3")), model).count() == 0
