"""The file-based jobs on the original folder layout (CSV ratings, JSON-lines
entities with string ids), built from the sf0.001 views."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ratewise.plans import jobs as J
from ratewise.sources import files as FS
from ratewise.sources import testdata as T

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def folder(spark):
    d = tempfile.mkdtemp(prefix="ratewise-jobs-")

    def single_file(df, name, fmt):
        tmp = f"{d}/_{name}"
        w = df.coalesce(1).write.mode("overwrite")
        (w.option("header", True).csv(tmp) if fmt == "csv" else w.json(tmp))
        part = [p for p in os.listdir(tmp) if p.startswith("part-")][0]
        os.rename(f"{tmp}/{part}", f"{d}/{name}")

    single_file(T.train(spark, SF_SMALL).select("user_id", "business_id", "stars"), "yelp_train.csv", "csv")
    single_file(T.requests(spark, SF_SMALL).select("user_id", "business_id", "stars"), "val.csv", "csv")
    single_file(T.items(spark, SF_SMALL), "business.json", "json")
    single_file(T.users(spark, SF_SMALL), "user.json", "json")
    single_file(T.reviews(spark, SF_SMALL), "review_train.json", "json")
    single_file(T.tips(spark, SF_SMALL), "tip.json", "json")
    single_file(T.photos(spark, SF_SMALL), "photo.json", "json")
    single_file(T.checkins(spark, SF_SMALL), "checkin.json", "json")
    return d


def test_hybrid_job(spark, folder, monkeypatch):
    from ratewise.operators import model as M
    monkeypatch.setattr(M, "MODEL_A_PARAMS", {"maxIter": 3, "maxDepth": 4, "seed": 42})
    out = f"{folder}/hybrid_out"
    J.run_hybrid(spark, folder, f"{folder}/val.csv", out)
    pred = FS.read_predictions(spark, out)
    n_req = FS.read_requests(spark, f"{folder}/val.csv").count()   # one line per request row
    assert pred.count() == n_req
    assert pred.where(F.col("prediction").isNull()).count() == 0


def test_feature_model_job(spark, folder):
    out = f"{folder}/fm_out"
    rmse = J.run_feature_model(spark, folder, f"{folder}/val.csv", out,
                               params={"maxIter": 3, "maxDepth": 3, "seed": 42}).first()
    n_req = FS.read_requests(spark, f"{folder}/val.csv").count()
    assert rmse.n == n_req and 0 < rmse.rmse < 3


def test_item_cf_job_matches_parquet_path(spark, folder):
    out = f"{folder}/cf_out"
    J.run_item_cf(spark, f"{folder}/yelp_train.csv", f"{folder}/val.csv", out)
    got = {(r.user_id, r.business_id): r.prediction for r in FS.read_predictions(spark, out).collect()}
    # ids are strings in the files; rank ties are broken by id in its own
    # type, so the parquet path is compared with string ids as well
    as_str = [F.col("user_id").cast("string").alias("user_id"),
              F.col("business_id").cast("string").alias("business_id"), "stars"]
    tr = T.train(spark, SF_SMALL).select(*as_str)
    rq = T.requests(spark, SF_SMALL).select(*as_str)
    exp = {(r.user_id, r.business_id): r.prediction for r in J.item_cf(tr, rq).collect()}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-9 for k in exp)


def test_command_line(spark, folder, capsys):
    from ratewise.__main__ import main
    out = f"{folder}/cli_out"
    main(["item-cf", f"{folder}/yelp_train.csv", f"{folder}/val.csv", out])
    assert "Duration" in capsys.readouterr().out
    n_req = FS.read_requests(spark, f"{folder}/val.csv").count()
    assert FS.read_predictions(spark, out).count() == n_req


def test_model_a_frames_are_single_precision(spark):
    import numpy as np
    tr, rq, feats = J.model_a_frames(T.train(spark, SF_SMALL), T.requests(spark, SF_SMALL),
                                     T.reviews(spark, SF_SMALL), T.users(spark, SF_SMALL),
                                     T.items(spark, SF_SMALL))
    vals = [v for r in tr.select("review_funny", "review_cool").limit(200).collect() for v in r]
    assert all(v == float(np.float32(v)) for v in vals if v is not None)
