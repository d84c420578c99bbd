"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole driver tables through ``ratewise.sources.testdata``
and returns a DataFrame.  Queries whose plans read the training table more
than once materialize it first; file round trips and model fits run their
writes and fits when called.  Doubles are rounded to 6 digits only here, at
the edge, so that the SQL oracle can compare values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from ratewise.functions.scalars import json_field, packed_list_len, rounded
from ratewise.operators import cf
from ratewise.operators import content as CT
from ratewise.operators import encode as E
from ratewise.operators import evaluate as EV
from ratewise.operators import features as FT
from ratewise.operators import model as MD
from ratewise.operators import profiles as P
from ratewise.operators import ratings as R
from ratewise.plans import artefacts as AF
from ratewise.plans import feature_frames as FF
from ratewise.plans import jobs as J
from ratewise.session import checkpoint_dir, small_hash_joins, store, store_bucketed
from ratewise.sources import files as FS
from ratewise.sources import testdata as T
from ratewise.streaming import scoring as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _split(spark, d):
    """Training rows and requests from all ratings, written once: both views derive
    them from the line items and orders."""
    every = store(T.ratings(spark, d), "ratings")
    return every.where(~T.is_request()), every.where(T.is_request())


def _train(spark, d):
    """The training table written once to the shared folder, for queries whose
    plans read it more than once (each read would otherwise re-derive it from
    the line items and orders)."""
    return store(T.train(spark, d).select("user_id", "business_id", "stars"), "train")


def _requests(spark, d):
    """The requests with their true ratings, written once likewise."""
    return store(T.requests(spark, d).select("user_id", "business_id", "stars"), "requests")


# ---------------------------------------------------------------- sources
@register("ratings_scan")
def ratings_scan(spark, d):
    return T.ratings(spark, d).select("user_id", "business_id", "stars")


@register("train_scan")
def train_scan(spark, d):
    return T.train(spark, d).select("user_id", "business_id", "stars")


@register("requests_scan")
def requests_scan(spark, d):
    return T.requests(spark, d).select("user_id", "business_id", "stars")


# ---------------------------------------------------------------- ratings algebra
@register("item_means")
def item_means(spark, d):
    return R.item_means(T.train(spark, d)).select(
        "business_id", rounded("item_mean").alias("item_mean"), F.col("item_n").cast("long"))


@register("user_means")
def user_means(spark, d):
    return R.user_means(T.train(spark, d)).select(
        "user_id", rounded("user_mean").alias("user_mean"), F.col("user_n").cast("long"))


@register("rater_sets")
def rater_sets(spark, d):
    return R.rater_sets(T.train(spark, d))


@register("rater_chunks")
def rater_chunks(spark, d):
    """Rater sets; the sorted array as a text."""
    return R.rater_chunks(T.train(spark, d)).withColumn("raters", F.array_join(F.col("raters").cast("array<string>"), ","))


@register("rater_overlap")
def rater_overlap(spark, d):
    """Common raters of every needed pair, none included."""
    train, pairs = _pairs(spark, d)
    return R.rater_overlap(pairs, store(R.rater_chunks(train), "chunks"))


@register("item_degrees")
def item_degrees(spark, d):
    return R.item_degrees(T.train(spark, d)).select("business_id", F.col("n_raters").cast("long"))


# ---------------------------------------------------------------- item-CF pieces
def _cf_inputs(spark, d):
    train, requests = _split(spark, d)
    status = store(cf.request_status(requests, train), "request-status")
    warm = (status.where(F.col("user_mean").isNotNull() & F.col("item_mean").isNotNull())
            .select("user_id", "business_id").distinct())
    cands = cf.candidates(warm, train)
    return train, status, cands


def _pairs(spark, d):
    """The training table and the needed pairs: written, as plans read them more than
    once, and laid out by their first item, of which there is a row for each other item
    at most."""
    train, _, cands = _cf_inputs(spark, d)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return train, store_bucketed(cf.needed_pairs(cands, parts), "pairs", "item_i", 0, 0)


@register("cold_requests")
def cold_requests(spark, d):
    _, status, _ = _cf_inputs(spark, d)
    return (status.where(F.col("user_mean").isNull() | F.col("item_mean").isNull())
            .select("user_id", "business_id",
                    F.when(F.col("user_mean").isNull(), F.lit("cold_user"))
                    .otherwise(F.lit("cold_item")).alias("reason")))


@register("cf_candidates")
def cf_candidates(spark, d):
    return _cf_inputs(spark, d)[2]


@register("item_pairs_needed")
def item_pairs_needed(spark, d):
    return cf.needed_pairs(_cf_inputs(spark, d)[2])


@register("co_raters")
def co_raters(spark, d):
    train, pairs = _pairs(spark, d)
    return cf.co_rating_rows(pairs, train)


@register("pair_stats")
def pair_stats(spark, d):
    train, pairs = _pairs(spark, d)
    return cf.pair_stats(pairs, train).select(
        "item_i", "item_j", "n", "sx", "sy", "sxy", "sxx", "syy", "sad")


def _similarity(spark, d):
    train, pairs = _pairs(spark, d)
    return cf.item_similarity(pairs, train, canonical=True)


def _sim_rule(rule):
    def q(spark, d):
        return (_similarity(spark, d).where(F.col("rule") == rule)
                .select("item_i", "item_j", rounded("weight").alias("weight")))
    return q


register("sim_mean_gap")(_sim_rule("mean_gap"))
register("sim_agreement")(_sim_rule("agreement"))
register("sim_pearson")(_sim_rule("pearson"))


@register("item_similarity")
def item_similarity(spark, d):
    return _similarity(spark, d).select("item_i", "item_j", "n", "rule",
                                        rounded("weight").alias("weight"))


@register("item_similarity_by_counts")
def item_similarity_by_counts(spark, d):
    train, pairs = _pairs(spark, d)
    return cf.item_similarity_by_counts(pairs, train).select(
        "item_i", "item_j", "n", "rule", rounded("weight").alias("weight"))


def _top(spark, d):
    """The heaviest neighbours of the warm requests.  Candidates stay with their user and
    get the weights that ``item_similarity`` gives their pairs (``cf.weighted_requests``)."""
    train, requests = _split(spark, d)
    prep = J.prepare_cf(train, written=True)
    status = store(cf.request_status(requests, prep), "request-status")
    warm = (status.where(F.col("user_mean").isNotNull() & F.col("item_mean").isNotNull())
            .groupBy("user_id", "business_id").agg(F.first("item_mean").alias("item_mean")))
    small_hash_joins(spark)
    return cf.top_neighbours(cf.weighted_requests(warm, prep, prep.by_item))


@register("top_neighbours")
def top_neighbours(spark, d):
    return _top(spark, d).select("user_id", "business_id", "neighbour", "rating",
                                 rounded("weight").alias("weight"), F.col("rank").cast("int"))


@register("cf_weighted_mean")
def cf_weighted_mean(spark, d):
    return cf.weighted_mean(_top(spark, d)).select(
        "user_id", "business_id", rounded("cf_score").alias("cf_score"))


@register("item_cf_predict_raw")
def item_cf_predict_raw(spark, d):
    """Item-CF on training rows with repeated pairs: means count every row, the
    neighbour ratings are the highest of a pair."""
    pred = J.item_cf(T.train_raw(spark, d), T.requests_raw(spark, d))
    return pred.select("user_id", "business_id", rounded("prediction").alias("prediction"), "source")


@register("item_means_raw")
def item_means_raw(spark, d):
    return R.item_means(T.train_raw(spark, d)).select(
        "business_id", rounded("item_mean").alias("item_mean"), F.col("item_n").cast("long"))


@register("item_cf_predict")
def item_cf_predict(spark, d):
    """Flagship: item-CF prediction for every request."""
    pred = J.item_cf(*_split(spark, d), written=True)
    return pred.select("user_id", "business_id", rounded("prediction").alias("prediction"), "source")


# ---------------------------------------------------------------- profiles


def _round_stats(df: DataFrame, keep: list[str], digits: int = 6) -> DataFrame:
    stats = [c for c in df.columns if c.startswith(("usr_", "bns_"))]
    return df.select(*keep, *[rounded(c, digits).alias(c) for c in stats])


def _fallback(spark, d):
    return P.global_profile(T.users(spark, d), T.items(spark, d))


@register("user_profile")
def user_profile(spark, d):
    return _round_stats(P.user_profile(T.train(spark, d)), ["user_id"], 9)


@register("item_profile")
def item_profile(spark, d):
    return _round_stats(P.item_profile(T.train(spark, d)), ["business_id"], 9)


@register("global_profile")
def global_profile(spark, d):
    return _round_stats(_fallback(spark, d), [])


@register("loo_train_features")
def loo_train_features(spark, d):
    train = _train(spark, d)
    pairs = train.select("user_id", "business_id", "stars", F.col("stars").alias("y"))
    out = P.loo_features(pairs, train, _fallback(spark, d), own_value="stars", keep=("y",))
    return _round_stats(out, ["user_id", "business_id", "y"])


@register("loo_request_features")
def loo_request_features(spark, d):
    train = _train(spark, d)
    out = P.loo_features(T.requests(spark, d).select("user_id", "business_id"), train,
                         _fallback(spark, d), own_value=None)
    return _round_stats(out, ["user_id", "business_id"])


@register("loo_train_features_raw")
def loo_train_features_raw(spark, d):
    """Repeated pairs: each training row leaves out one copy of its own rating."""
    train = store(T.train_raw(spark, d), "train-raw")
    pairs = train.select("user_id", "business_id", "stars", F.col("stars").alias("y"))
    out = P.loo_features(pairs, train, _fallback(spark, d), own_value="stars", keep=("y",))
    return _round_stats(out, ["user_id", "business_id", "y"])


@register("loo_request_features_raw")
def loo_request_features_raw(spark, d):
    """Repeated pairs: a request leaves out all training rows of its pair."""
    train = store(T.train_raw(spark, d), "train-raw")
    out = P.loo_features(T.requests_raw(spark, d), train, _fallback(spark, d), own_value=None)
    return _round_stats(out, ["user_id", "business_id"])


# ---------------------------------------------------------------- features


def _round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[rounded(f.name).alias(f.name) if f.dataType.typeName() in ("double", "float")
                       else F.col(f.name) for f in df.schema.fields])


def _inputs(spark, d) -> FF.Inputs:
    """The ratings, items and users are written once: frames read them several times,
    and each read would otherwise derive them from line items and orders."""
    return FF.Inputs(*_split(spark, d), store(T.items(spark, d), "items"), store(T.users(spark, d), "users"),
                     T.tips(spark, d), T.photos(spark, d), T.checkins(spark, d))


@register("review_means")
def review_means(spark, d):
    return _round_doubles(FT.review_means(T.reviews(spark, d)))


@register("tip_counts")
def tip_counts(spark, d):
    return FT.tip_counts(T.tips(spark, d))


@register("photo_counts")
def photo_counts(spark, d):
    return FT.photo_counts(T.photos(spark, d))


@register("checkin_slots")
def checkin_slots(spark, d):
    return FT.checkin_slots(T.checkins(spark, d))


@register("packed_list_len")
def packed_list_len_q(spark, d):
    u = T.users(spark, d)
    return u.select("user_id", "elite", "friends", packed_list_len("elite").alias("elite_len"),
                    packed_list_len("friends").alias("friends_len"))


@register("json_props")
def json_props(spark, d):
    ev = T.table(spark, d, "events").select("event_id", "event_type", "props")
    return ev.select("event_id", "event_type", json_field("props", "k", "bigint").alias("k"))


@register("relevant_users")
def relevant_users(spark, d):
    return FT.relevant_users(T.users(spark, d), T.train(spark, d), T.requests(spark, d)).select("user_id")


@register("user_features")
def user_features(spark, d):
    inp = _inputs(spark, d)
    return FT.user_features(FT.relevant_users(inp.users, inp.train, inp.requests))


@register("feature_vector8")
def feature_vector8(spark, d):
    tr = T.train(spark, d).select("user_id", "business_id", F.col("stars").alias("y"))
    return _round_doubles(FT.feature_vector8(tr, T.reviews(spark, d), T.users(spark, d), T.items(spark, d)))


@register("attribute_profile")
def attribute_profile(spark, d):
    return _round_doubles(E.attribute_profile(T.items(spark, d)))


@register("selected_attributes")
def selected_attributes(spark, d):
    return _round_doubles(E.selected_attributes(T.items(spark, d)))


def _cells(df: DataFrame, keys: list[str], columns: list[str], key: str, value: str) -> DataFrame:
    """The non-NULL cells of some columns as rows: the wide tables have
    data-dependent columns, which a fixed statement cannot name."""
    entries = F.array(*[F.struct(F.lit(c).alias(key), F.col(f"`{c}`").cast("string").alias(value))
                        for c in columns]) if columns else \
        F.array().cast(f"array<struct<{key}:string,{value}:string>>")
    return df.select(*keys, F.inline(entries)).where(F.col(value).isNotNull())


def _cell_text(columns: list[str], cell) -> Column:
    """The non-NULL texts of ``cell(column)``, joined by ``;`` in column order."""
    return F.concat_ws(";", *[cell(c) for c in sorted(columns)])


@register("item_attributes_wide")
def item_attributes_wide(spark, d):
    """The selected attributes of each item: the cells of the wide table."""
    items = T.items(spark, d)
    keys = E.selected_keys(items)
    return _cells(E.item_attributes_wide(items, keys), ["business_id"], keys, "attr_key", "attr_value")


def _merged(spark, d):
    inp = _inputs(spark, d)
    fb, keys = FF.fallback_profile(inp), E.selected_keys(inp.items)
    return FF.merged_training(inp, fb, keys), fb, keys


def _with_attributes(df: DataFrame, keys: list[str]) -> DataFrame:
    text = _cell_text(keys, lambda k: F.concat(F.lit(f"{k}="), F.col(f"`{k}`")))
    return _round_doubles(df.withColumn("attributes", text).drop(*keys))


@register("feature_merge")
def feature_merge(spark, d):
    """Merged training frame of all item tables and the user table, before
    encoding and filling; the attribute columns as one text."""
    merged, _, keys = _merged(spark, d)
    return _with_attributes(merged, keys)


@register("fill_missing")
def fill_missing(spark, d):
    merged, fb, keys = _merged(spark, d)
    return _with_attributes(FT.fill_missing(merged, fb), keys)


def _onehot(spark, d, side):
    """Non-zero cells of the encoded matrix, training vocabulary."""
    inp = _inputs(spark, d)
    keys = E.selected_keys(inp.items)
    vocab = FF.training_vocabulary(inp, keys)
    # the encoded cells depend only on the attribute columns of the frame:
    # the pairs left-joined to the selected attributes of their items
    pairs = (inp.train if side == "train" else inp.requests).select("user_id", "business_id")
    frame = pairs.join(E.item_attributes_wide(inp.items, keys), "business_id", "left")
    names = [name for _, _, name in E.onehot_names(vocab)]
    cells = _cells(E.onehot_transform(frame, vocab), ["user_id", "business_id"], names, "feature", "cell")
    return cells.where("cell <> '0'").select("user_id", "business_id", "feature")


@register("onehot_train")
def onehot_train(spark, d):
    return _onehot(spark, d, "train")


@register("onehot_requests")
def onehot_requests(spark, d):
    return _onehot(spark, d, "requests")


def _without_cells(df: DataFrame, vocab: dict) -> DataFrame:
    names = [name for _, _, name in E.onehot_names(vocab)]
    text = _cell_text(names, lambda n: F.when(F.col(f"`{n}`") != 0, F.lit(n)))
    return _round_doubles(df.withColumn("onehot", text).drop(*names))


@register("model_a_frame")
def model_a_frame(spark, d):
    """The matrix model A is fitted on: single precision, sentinel, indicators."""
    tr, _, feats = J.model_a_frames(T.train(spark, d), T.requests(spark, d), T.reviews(spark, d),
                                    T.users(spark, d), T.items(spark, d))
    return _round_doubles(tr.select("user_id", "business_id", "y", *feats))


@register("model_a_frame_two_sided")
def model_a_frame_two_sided(spark, d):
    """The matrix as model A's pipeline encodes it: every feature with its missing
    values below and above all others."""
    raw = AF.model_a_raw(T.train(spark, d).select("user_id", "business_id"), T.reviews(spark, d),
                         T.users(spark, d), T.items(spark, d))
    return _round_doubles(AF.encoded(raw, AF.two_sided_cells(FT.VECTOR8), "user_id", "business_id"))


@register("model_b_frame")
def model_b_frame(spark, d):
    """The matrix model B is fitted on; its indicator columns as one text."""
    frames = FF.build(_inputs(spark, d))
    return _without_cells(frames.train.select("user_id", "business_id", "y", *frames.features), frames.vocab)


@register("model_b_request_frame")
def model_b_request_frame(spark, d):
    frames = FF.build(_inputs(spark, d))
    return _without_cells(frames.requests.select("user_id", "business_id", *frames.features), frames.vocab)


# ---------------------------------------------------------------- models, blend, evaluation


def _cf_pred(spark, d):
    """Item-CF predictions, and the requests with their true ratings."""
    train, requests = _split(spark, d)
    return J.item_cf(train, requests, written=True), requests


@register("rmse_eval")
def rmse_eval(spark, d):
    """RMSE of the item-CF predictions against the held-out ratings."""
    return EV.rmse(*_cf_pred(spark, d)).select("n", rounded("rmse").alias("rmse"))


@register("error_bands")
def error_bands(spark, d):
    return EV.error_bands(*_cf_pred(spark, d))


@register("ranking_eval")
def ranking_eval(spark, d):
    """Precision, recall and NDCG of each user's ranked requests by item-CF."""
    return _round_doubles(EV.ranking(*_cf_pred(spark, d)))


@register("ranking_summary")
def ranking_summary(spark, d):
    return _round_doubles(EV.ranking_summary(EV.ranking(*_cf_pred(spark, d))))


@register("item_terms")
def item_terms(spark, d):
    return _round_doubles(CT.item_terms(T.items(spark, d)))


@register("content_predict")
def content_predict(spark, d):
    """Content-based prediction for every request."""
    return _round_doubles(CT.predict(*_split(spark, d), T.items(spark, d)))


@register("content_rmse")
def content_rmse(spark, d):
    train, req = _split(spark, d)
    pred = CT.predict(train, req, T.items(spark, d))
    return _round_doubles(EV.rmse(pred, req))


@register("hybrid_blend")
def hybrid_blend(spark, d):
    """0.1 * item-CF + 0.9 * a second score that SQL can restate: the item's
    training mean (user mean for a cold item, 3.75 for a cold user)."""
    train, req = _split(spark, d)
    st = cf.request_status(req, train)
    second = st.select("user_id", "business_id",
                       F.coalesce("item_mean", "user_mean", F.lit(cf.COLD_USER_VALUE)).alias("prediction"))
    out = EV.blend(J.item_cf(train, req, written=True), second)
    return out.select("user_id", "business_id", rounded("prediction").alias("prediction"))


def _scored(spark, d, which: str) -> DataFrame:
    """The requests scored by model A or B at the original settings.  The model is
    an artefact of the tables' files and its settings: fitted where the shared
    folder has none, loaded where it has."""
    if which == "a":
        tables = [T.table(spark, d, n) for n in ("lineitem", "orders", "part", "customer")]
        reviews, users, items = T.reviews(spark, d), T.users(spark, d), T.items(spark, d)
        fitted = AF.fitted_once(spark, "a", tables, MD.MODEL_A_PARAMS,
                                lambda: AF.fit_model_a(T.train(spark, d), reviews, users, items))
        return AF.score_model_a(fitted, T.requests(spark, d), reviews, users, items)
    tables = [T.table(spark, d, n) for n in ("lineitem", "orders", "part", "customer", "events")]
    inp = _inputs(spark, d)
    return AF.score_feature_model(AF.fitted_once(spark, "b", tables, MD.MODEL_B_PARAMS,
                                                 lambda: AF.fit_feature_model(inp)), inp)


@register("model_a_predict")
def model_a_predict(spark, d):
    """Model A (8 looked-up features, 50 trees of depth 10)."""
    return _scored(spark, d, "a")


@register("model_a_rmse")
def model_a_rmse(spark, d):
    return EV.rmse(_scored(spark, d, "a"), T.requests(spark, d))


@register("hybrid_blend_model")
def hybrid_blend_model(spark, d):
    """The hybrid job: 0.1 * item-CF + 0.9 * model A."""
    return EV.blend(_cf_pred(spark, d)[0], _scored(spark, d, "a"))


@register("model_b_predict")
def model_b_predict(spark, d):
    """Model B on the full feature frame (400 trees of depth 5)."""
    return _scored(spark, d, "b")


@register("model_b_rmse")
def model_b_rmse(spark, d):
    return EV.rmse(_scored(spark, d, "b"), T.requests(spark, d))


# ---------------------------------------------------------------- file sources and sinks


def _scratch(spark, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/ratewise-io/{name}-{uuid.uuid4().hex}"


def _attributes_text(col: str = "attributes"):
    """A map as sorted ``key=value`` entries joined by ``;`` (NULL stays NULL)."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(col),
                                                 lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")


@register("items_scan")
def items_scan(spark, d):
    it = T.items(spark, d)
    return it.select("business_id", "stars", "review_count", "latitude",
                     _attributes_text().alias("attributes"))


@register("users_scan")
def users_scan(spark, d):
    return T.users(spark, d)


@register("ratings_csv_roundtrip")
def ratings_csv_roundtrip(spark, d):
    """Training ratings written as CSV and read back with the ratings schema
    (ids as strings, as in the original CSV files)."""
    path = _scratch(spark, "ratings")
    FS.write_csv(T.train(spark, d).select("user_id", "business_id", "stars"), path)
    return FS.read_ratings(spark, path)


@register("items_json_roundtrip")
def items_json_roundtrip(spark, d):
    """Item records written as JSON lines and read back with the item schema."""
    path = _scratch(spark, "items")
    FS.write_json_lines(T.items(spark, d), path)
    it = FS.read_items(spark, path)
    return it.select("business_id", "stars", "review_count", "latitude",
                     _attributes_text().alias("attributes"))


@register("users_json_roundtrip")
def users_json_roundtrip(spark, d):
    path = _scratch(spark, "users")
    FS.write_json_lines(T.users(spark, d), path)
    return FS.read_users(spark, path)


def _json_roundtrip(spark, df: DataFrame, name: str, read) -> DataFrame:
    path = _scratch(spark, name)
    FS.write_json_lines(df, path)
    return read(spark, path)


@register("reviews_json_roundtrip")
def reviews_json_roundtrip(spark, d):
    return _round_doubles(_json_roundtrip(spark, T.reviews(spark, d), "reviews", FS.read_reviews))


@register("tips_json_roundtrip")
def tips_json_roundtrip(spark, d):
    return _json_roundtrip(spark, T.tips(spark, d), "tips", FS.read_tips)


@register("photos_json_roundtrip")
def photos_json_roundtrip(spark, d):
    return _json_roundtrip(spark, T.photos(spark, d), "photos", FS.read_photos)


@register("checkins_json_roundtrip")
def checkins_json_roundtrip(spark, d):
    """Check-in maps read back, one row per slot."""
    back = _json_roundtrip(spark, T.checkins(spark, d), "checkins", FS.read_checkins)
    return back.select("business_id", F.explode("time").alias("slot", "n"))


def _dirty(spark, df: DataFrame, name: str) -> str:
    """The rows as JSON lines of which some are spoilt: of the items (users) whose
    number leaves 3 modulo 11 the line is cut short, with 5 modulo 13 it is
    followed by a second record, and with 7 modulo 17 its first number field has
    a text for a value (where it has such a field)."""
    key = F.coalesce(F.col(df.columns[0]).cast("bigint"), F.lit(0))
    line = F.to_json(F.struct(*df.columns))
    number = next((f.name for f in df.schema.fields[1:] if f.dataType.typeName() in ("double", "long")), None)
    text = F.regexp_replace(line, f'"{number}":[0-9.E-]+', f'"{number}":"?"') if number else line
    spoilt = (F.when(key % 11 == 3, F.substr(line, F.lit(1), F.length(line) - 1))
              .when(key % 13 == 5, F.concat(line, F.lit(" "), line))
              .when(key % 17 == 7, text).otherwise(line))
    path = _scratch(spark, name)
    df.select(spoilt.alias("value")).write.text(path)
    return path


def _json_sources(spark, d):
    """Name, rows and schema of every JSON source."""
    return {"items": (T.items(spark, d), FS.ITEM_SCHEMA), "users": (T.users(spark, d), FS.USER_SCHEMA),
            "reviews": (T.reviews(spark, d), FS.REVIEW_SCHEMA), "tips": (T.tips(spark, d), FS.TIP_SCHEMA),
            "photos": (T.photos(spark, d), FS.PHOTO_SCHEMA), "checkins": (T.checkins(spark, d), FS.CHECKIN_SCHEMA)}


def _dirty_read(name: str):
    """The good rows of a spoilt file: all rows but those of broken lines."""
    def query(spark, d):
        df, schema = _json_sources(spark, d)[name]
        got = FS.read_json_lines(spark, _dirty(spark, df, name), schema, on_bad_rows="drop")
        if name == "items":
            got = got.withColumn("attributes", _attributes_text())
        if name == "checkins":
            return got.select("business_id", F.explode("time").alias("slot", "n"))
        return _round_doubles(got)
    return query


for _name in ("items", "users", "reviews", "tips", "photos", "checkins"):
    register(f"{_name}_json_dirty")(_dirty_read(_name))


@register("json_bad_rows")
def json_bad_rows(spark, d):
    """How many lines of each spoilt file are bad, by reason."""
    out = None
    for name, (df, schema) in _json_sources(spark, d).items():
        bad = FS.bad_json_rows(spark, _dirty(spark, df, name), schema).groupBy("reason").agg(
            F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("file"), "reason", "n")
        out = bad if out is None else out.unionByName(bad)
    return out


@register("predictions_sink")
def predictions_sink(spark, d):
    """Item-CF predictions written as CSV (header ``user_id,business_id,
    prediction``) and read back."""
    path = _scratch(spark, "predictions")
    pred = J.item_cf(*_split(spark, d), written=True)
    FS.write_predictions(pred.select("user_id", "business_id", rounded("prediction").alias("prediction")),
                         path)
    schema = TY.StructType([TY.StructField("user_id", TY.LongType()),
                            TY.StructField("business_id", TY.LongType()),
                            TY.StructField("prediction", TY.DoubleType())])
    return FS.read_predictions(spark, path, schema)


@register("fallback_roundtrip")
def fallback_roundtrip(spark, d):
    """The fallback profile written as a named one-row CSV and read back."""
    path = _scratch(spark, "fallback")
    FS.write_fallback(_fallback(spark, d), path)
    return _round_stats(FS.read_fallback(spark, path), [])


# ---------------------------------------------------------------- streaming


@register("item_cf_stream")
def item_cf_stream(spark, d):
    """The requests written as CSV files and scored by the streaming job
    (some files per micro-batch); the result must equal the batch flagship."""
    src, sink = _scratch(spark, "stream-src"), _scratch(spark, "stream-sink")
    req = T.requests(spark, d).select("user_id", "business_id", "stars")
    FS.write_csv(req, src)
    schema = TY.StructType([TY.StructField("user_id", TY.LongType()),
                            TY.StructField("business_id", TY.LongType()),
                            TY.StructField("stars", TY.DoubleType())])
    prepared = J.prepare_cf(T.train(spark, d))
    q = ST.score_stream(prepared, ST.request_stream(spark, src, schema, files_per_batch=4), sink)
    q.awaitTermination()
    out = ST.read_scored(spark, sink)
    return out.select("user_id", "business_id", rounded("prediction").alias("prediction"), "source")
