"""End-to-end rating-prediction jobs on DataFrames.

* ``item_cf``      - item-to-item CF for every request.
* ``model_a``      - boosted trees on the 8 looked-up features.
* ``hybrid``       - ``0.1 * item_cf + 0.9 * model_a``, aligned by key.
* ``feature_model``- boosted trees on the full encoded frame (model B).

``run_*`` variants read the file layout of the original jobs (a folder with
``yelp_train.csv``, ``user.json``, ``business.json``, ``review_train.json``,
``tip.json``, ``photo.json``, ``checkin.json``) and write a prediction CSV.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators import cf
from ratewise.operators import evaluate as EV
from ratewise.operators import features as FT
from ratewise.operators import model as M
from ratewise.plans import artefacts as AF
from ratewise.plans import feature_frames as FF
from ratewise.session import scratch_scope, store, store_bucketed
from ratewise.sources import files

KEYS = ["user_id", "business_id"]


def item_cf(train: DataFrame, requests: DataFrame, written: bool = False, **kw) -> DataFrame:
    """Predictions from a training table that is written once, with its means,
    so that every branch of the plan reads the written tables.  ``written``: ``train``
    reads a written table already."""
    return cf.predict(prepare_cf(train, dedupe=kw.get("dedupe", True), written=written), requests, **kw)


def prepare_cf(train: DataFrame, dedupe: bool = True, written: bool = False) -> cf.Prepared:
    """The training table's ratings bucketed and sorted by user and once more by
    item, and the tables of users and items laid out alike: a batch of requests is
    dealt to them, they are not moved.  A key with more than a bucket's share of the
    ratings leaves that copy of them unbucketed (``store_bucketed``)."""
    train = train.select(*KEYS, "stars")
    prep = cf.prepare(train if written else store(train, "train"), dedupe)
    lookup = store(prep.lookup, "lookup")
    shape = {}
    for key in KEYS:
        counts = store(lookup.groupBy(key).agg(F.count(F.lit(1)).alias("n")), f"count-{key}")
        most, rows, keys = counts.agg(F.max("n"), F.sum("n"), F.count(F.lit(1))).first()
        shape[key] = counts, most or 0, rows or 0, keys
    by = {key: store_bucketed(lookup, f"lookup-{key}", key, shape[key][1], shape[key][2]) for key in KEYS}
    one = {key: lambda df, name, key=key: store_bucketed(df, name, key, 1, shape[key][3]) for key in KEYS}
    return cf.Prepared(one["user_id"](prep.user_means, "user-means"), one["business_id"](prep.item_means, "item-means"),
                       by["user_id"], one["user_id"](shape["user_id"][0], "degrees"), shape["user_id"][1],
                       by["business_id"])


def _narrow(df: DataFrame, cols) -> DataFrame:
    """Round values to single precision (as the original model job fed its
    learner float32 arrays); NULLs stay NULL."""
    cols = set(cols)
    return df.select(*[F.col(c).cast("float").cast("double").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def model_a_frames(train, requests, reviews, users, items, float32: bool = True):
    FT.assert_unique(items, "business_id", "items")
    FT.assert_unique(users, "user_id", "users")
    tr = FT.feature_vector8(train.select(*KEYS, F.col("stars").cast("double").alias("y")),
                            reviews, users, items)
    rq = FT.feature_vector8(requests.select(*KEYS).distinct(), reviews, users, items)
    if float32:
        tr = _narrow(tr, list(FT.VECTOR8) + ["y"])
        rq = _narrow(rq, FT.VECTOR8)
    tr, feats = M.impute_with_indicators(tr, list(FT.VECTOR8))
    rq, _ = M.impute_with_indicators(rq, list(FT.VECTOR8))
    return tr, rq, feats


def model_a(train, requests, reviews, users, items, params: dict | None = None) -> DataFrame:
    """One prediction per distinct request pair."""
    fitted = AF.fit_model_a(train, reviews, users, items, params)
    return AF.score_model_a(fitted, requests, reviews, users, items)


def hybrid(train, requests, reviews, users, items, alpha: float = EV.ALPHA,
           params: dict | None = None) -> DataFrame:
    train = store(train.select(*KEYS, "stars"), "train")
    cf_pred = item_cf(train, requests.select(*KEYS).distinct())
    model_pred = model_a(train, requests, reviews, users, items, params)
    return EV.blend(cf_pred, model_pred, alpha)


def feature_model(inp: FF.Inputs, params: dict | None = None) -> DataFrame:
    return AF.score_feature_model(AF.fit_feature_model(inp, params), inp)


# ------------------------------------------------------------------ file jobs
def per_request_row(requests: DataFrame, pred: DataFrame) -> DataFrame:
    """One output row per request row (duplicates kept), from predictions
    made once per distinct pair."""
    return requests.select(*KEYS).join(pred.select(*KEYS, "prediction"), KEYS, "left")


def _folder_inputs(spark: SparkSession, folder: str, requests_path: str | None) -> FF.Inputs:
    """Without requests, the training pairs stand for them."""
    f = folder.rstrip("/")
    train = files.read_ratings(spark, f"{f}/yelp_train.csv")
    return FF.Inputs(
        train=train,
        requests=train if requests_path is None else files.read_requests(spark, requests_path),
        items=files.read_items(spark, f"{f}/business.json"),
        users=files.read_users(spark, f"{f}/user.json"),
        tips=files.read_tips(spark, f"{f}/tip.json"),
        photos=files.read_photos(spark, f"{f}/photo.json"),
        checkins=files.read_checkins(spark, f"{f}/checkin.json"),
    )


def run_item_cf(spark: SparkSession, train_path: str, requests_path: str, out_path: str) -> None:
    with scratch_scope(spark):
        pred = item_cf(files.read_ratings(spark, train_path), files.read_requests(spark, requests_path))
        files.write_predictions(pred, out_path)


def run_model_a(spark: SparkSession, folder: str, requests_path: str, out_path: str) -> None:
    inp = _folder_inputs(spark, folder, requests_path)
    reviews = files.read_reviews(spark, f"{folder.rstrip('/')}/review_train.json")
    with scratch_scope(spark):
        pred = model_a(inp.train, inp.requests, reviews, inp.users, inp.items)
        files.write_predictions(per_request_row(inp.requests, pred), out_path)


def run_hybrid(spark: SparkSession, folder: str, requests_path: str, out_path: str) -> None:
    inp = _folder_inputs(spark, folder, requests_path)
    reviews = files.read_reviews(spark, f"{folder.rstrip('/')}/review_train.json")
    with scratch_scope(spark):
        pred = hybrid(inp.train, inp.requests, reviews, inp.users, inp.items)
        files.write_predictions(per_request_row(inp.requests, pred), out_path)


def run_feature_model(spark: SparkSession, folder: str, requests_path: str, out_path: str,
                      params: dict | None = None) -> DataFrame:
    """Writes the predictions and returns the one-row RMSE against the
    requests' ``stars`` (when the request file carries them)."""
    inp = _folder_inputs(spark, folder, requests_path)
    with scratch_scope(spark):
        pred = per_request_row(inp.requests, feature_model(inp, params))
        files.write_predictions(pred, out_path)
    written = files.read_predictions(spark, out_path)
    truth = inp.requests.where(F.col("stars").isNotNull())
    return EV.rmse(written, truth)


def run_fit(spark: SparkSession, model: str, folder: str, artefact: str, params: dict | None = None) -> None:
    """Fit model ``a`` or ``b`` on the folder's files and save it."""
    inp = _folder_inputs(spark, folder, None)
    with scratch_scope(spark):
        if model == "a":
            reviews = files.read_reviews(spark, f"{folder.rstrip('/')}/review_train.json")
            AF.fit_model_a(inp.train, reviews, inp.users, inp.items, params).save(artefact)
        else:
            AF.fit_feature_model(inp, params).save(artefact)


def run_score(spark: SparkSession, model: str, folder: str, artefact: str, requests_path: str, out_path: str) -> None:
    """Score a request file with a saved model."""
    inp, fitted = _folder_inputs(spark, folder, requests_path), AF.load(spark, artefact)
    if model == "a":
        reviews = files.read_reviews(spark, f"{folder.rstrip('/')}/review_train.json")
        pred = AF.score_model_a(fitted, inp.requests, reviews, inp.users, inp.items)
    else:
        pred = AF.score_feature_model(fitted, inp)
    files.write_predictions(per_request_row(inp.requests, pred), out_path)
