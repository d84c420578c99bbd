"""Content-based prediction: items alike by their attributes.

An item's terms are its attribute entries, each with the weight
``ln(items / items that have it)``; weights are divided by their Euclidean norm,
so the similarity of two items is the sum over their common terms of the products
of weights (the cosine).  A request scores the weighted mean of the user's
ratings of the ``TOP_K`` items most alike to the requested one, like the
neighbourhood score of ``ratewise.operators.cf``; where no rated item has a term
in common it scores the user's mean, and ``COLD_USER_VALUE`` for a user without
ratings.

An item's terms travel as one row, under numbers, with the requests of the item
and with the ratings of it.  Both meet at the user, where the similarity is
taken in place: no pair of items and no candidate moves, and a candidate costs no
more than its two items' terms.

An item without attributes, or whose entries all items have, has no terms.
Entries with a NULL value are no terms.  Ties between neighbours go to the
smaller id, after rounding to 9 digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.operators import cf
from ratewise.operators import ratings as R
from ratewise.operators.encode import attribute_pairs
from ratewise.operators.ratings import ITEM, STARS, USER
from ratewise.session import by_first_key, store


VECTOR = ("item_terms", "item_weights")


def _numbered_terms(items: DataFrame) -> DataFrame:
    """``item_terms`` with ``term``, a number for each key and value."""
    pairs = attribute_pairs(items).where("attr_value is not null").distinct()
    total = items.agg(F.count_distinct(ITEM).cast("double").alias("_total"))
    # written first: planned from file sizes before the maps are cut to rows, the
    # join would broadcast the terms of all items rather than this table
    idf = store(pairs.groupBy("attr_key", "attr_value").agg(F.count(F.lit(1)).alias("_df"))
                .crossJoin(F.broadcast(total))                       # one row
                .select("attr_key", "attr_value", F.ln(F.col("_total") / F.col("_df")).alias("_idf")).where("_idf > 0")
                .withColumn("term", F.monotonically_increasing_id()),
                "idf")
    terms = pairs.where(F.col(ITEM).isNotNull()).join(idf, ["attr_key", "attr_value"])
    # over a window: a table of the items' norms could be broadcast, and grows with the items
    norm = F.sqrt(F.sum(F.col("_idf") * F.col("_idf")).over(Window.partitionBy(ITEM)))
    return terms.select(ITEM, "attr_key", "attr_value", "term", (F.col("_idf") / norm).alias("weight"))


def item_terms(items: DataFrame) -> DataFrame:
    """``(business_id, attr_key, attr_value, weight)``, one row per term of an
    item; an item's squared weights add up to 1."""
    return _numbered_terms(items).drop("term")


def item_vectors(items: DataFrame) -> DataFrame:
    """``(business_id, item_terms, item_weights)``: the terms of an item as one row,
    the numbers in order and their weights beside them."""
    both = _numbered_terms(items).groupBy(ITEM).agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("_t"))
    return both.select(ITEM, F.col("_t.term").alias(VECTOR[0]), F.col("_t.weight").alias(VECTOR[1]))


def content_similarity(cands: DataFrame) -> DataFrame:
    """The candidates (``cf.candidates`` with both items' ``item_vectors``) that have a
    term in common, with the cosine as ``weight`` in place of the vectors."""
    terms, weights, their_terms, their_weights = (F.col(c) for side in ("item", "neighbour")
                                                  for c in (f"{side}_terms", f"{side}_weights"))
    # of a term that the item lacks the position is 0, and there is no weight before the first
    products = F.zip_with(their_terms, their_weights, lambda t, w: w * F.coalesce(
        F.get(weights, F.array_position(terms, t).cast("int") - 1), F.lit(0.0)))
    weight = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    keep = [c for c in cands.columns if not c.endswith(("_terms", "_weights"))]
    return cands.where(F.arrays_overlap(terms, their_terms)).select(*keep, weight.alias("weight"))


def predict(train: DataFrame, requests: DataFrame, items: DataFrame, k: int = cf.TOP_K,
            cold_user_value: float = cf.COLD_USER_VALUE) -> DataFrame:
    """``(user_id, business_id, prediction, source)`` of every request row; source
    is ``cold_user``, ``user_mean`` or ``content``.  ``train`` is read several
    times and best a written table; of repeated pairs the highest rating counts,
    and NULL ratings do not."""
    by_first_key(train.sparkSession)
    rated = train.where(F.col(STARS).isNotNull())
    means = R.user_means(rated).select(USER, "user_mean", F.col("user_n").alias("n"))
    status = requests.select(USER, ITEM).join(means.drop("n"), USER, "left")
    # written first, so that a join knows how large they are
    vectors = store(item_vectors(items), "item-vectors")
    warm = status.where("user_mean is not null").select(USER, ITEM).distinct().join(vectors, ITEM)
    cands = cf.candidates(warm, R.dedupe(rated).join(vectors, ITEM), exclude_self=True, degrees=means, keep=VECTOR)
    scores = cf.weighted_mean(cf.top_neighbours(content_similarity(cands), k), cold_user_value)
    out = status.join(scores, [USER, ITEM], "left")
    mean, score = F.col("user_mean"), F.col("cf_score")
    return out.select(
        USER, ITEM, F.coalesce(score, mean, F.lit(cold_user_value)).cast("double").alias("prediction"),
        F.when(mean.isNull(), F.lit("cold_user")).when(score.isNull(), F.lit("user_mean"))
        .otherwise(F.lit("content")).alias("source"))
