"""What the pipeline's stages keep in an executor: one Python step at a time, and no text moved for a few keys."""
from pyspark.sql import functions as F

from ratewise.llm import components as C
from ratewise.llm import winnow


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_components_follow_no_other_python_step(spark, monkeypatch):
    plans, kept = [], C.store
    monkeypatch.setattr(C, "store", lambda df, name: plans.append(_plan(df)) or kept(df, name))
    pairs = spark.createDataFrame([(1, 2), (3, 2), (5, 6), (6, 6), (9, 9)], "a bigint, b bigint")
    got = C.components(pairs.mapInArrow(lambda batches: batches, "a bigint, b bigint"))
    assert sorted(map(tuple, got.collect())) == [(2, 1), (3, 1), (6, 5)]
    assert max(p.count("MapInArrow") for p in plans) == 1, plans


def test_clean_moves_no_text(spark):
    docs = spark.createDataFrame([(k, f"word{k} " + ("two three" if k % 10 == 0 else "other")) for k in range(60)],
                                 "doc_id bigint, text string")
    got = winnow.clean(docs, spark.createDataFrame([(1, "two three")], "item_id bigint, text string"))
    assert "hashpartitioning" not in _plan(got)
    assert sorted(r.doc_id for r in got.select("doc_id", F.length("text")).collect()) == [k for k in range(60) if k % 10]
