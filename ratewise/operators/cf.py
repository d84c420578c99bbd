"""Item-to-item collaborative filtering as one lazy DataFrame plan.

For a request (u, b): a user absent from training scores ``cold_user_value``
(3.75); an item absent from training scores the user's mean; otherwise every
item b' the user rated is a neighbour with weight w(b, b') and rating r(u, b'),
the 15 heaviest neighbours are kept and the score is
``sum(w * r) / sum(|w|)`` (``cold_user_value`` when that sum is 0).  Negative
weights are kept and scores are not clipped.

w(i, j) depends on the number n of users who rated both items:

* n <= 1: ``(5 - |mean_i - mean_j|) / 5`` with the items' global means;
* n == 2: mean over the two co-raters of ``(5 - |x - y|) / 5``;
* n >= 3: Pearson correlation over the co-raters (means over co-raters
  only), 0 when either variance is 0.

Plan shape (no collect, no Python):

1. request status: requests left-joined to per-user / per-item means;
2. candidates: warm requests joined to the user's training rows;
3. needed pairs: the canonical ``(least, greatest)`` item pairs of the
   candidates, i.e. only the pairs some request needs;
4. co-rating rows of the needed pairs.  Ratings are first cut down to the items
   of needed pairs.  One end of each pair is a requested item (a *hub*); a user's
   items go to each of their hubs as 16-bit marks, and only those that the hub is
   paired with are looked up (``found_rows``): what one request costs follows from
   the raters of its item, not from all users.  Users whose list would exceed
   ``ratewise.cf.expandItems`` squared are looked up from the pairs instead;
5. weights (``weighted_requests``): candidates stay with their user and hold both
   items' means, which decide pairs with at most one co-rater; the weights of the
   others are moved to them.  Top-k neighbours per request follow with
   ``row_number`` over a window filtered to ``<= k``, in the same place;
6. weighted mean per request, joined back to the request status.

There is one plan for every size.  Joins whose rows per key multiply
(requests x ratings of a user, pairs x heavy raters of an item) are salted by
that product (``ratewise.operators.skew``); all others have one row per key on
one side and are left to AQE, which broadcasts by measured size and splits
skewed partitions.  ``prepare`` computes what depends on the training table
alone, for callers that score many batches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions.moments import scatter
from ratewise.operators import ratings as R
from ratewise.operators.skew import salted_join
from ratewise.session import by_first_key, small_hash_joins, store, store_bucketed

USER, ITEM, STARS = R.USER, R.ITEM, R.STARS

# Fixed values of the original item-CF job.
COLD_USER_VALUE = 3.75   # score of a user with no training rating
TOP_K = 15               # neighbours kept per request
MAX_STARS = 5.0          # scale constant of the mean-gap / agreement rules

EXPAND_CONF, DEFAULT_EXPAND_ITEMS = "ratewise.cf.expandItems", 500
SUMS = ("n", "sx", "sy", "sxy", "sxx", "syy", "sad")
ASKED_MARKS = 128        # marks that a request takes along at most
NEAR_MARKS = 4096        # marks of a hub's partners up to which a user's items are compared with them


@dataclass
class Prepared:
    """What predictions need of the training table."""
    user_means: DataFrame     # user_id, user_mean (all rows)
    item_means: DataFrame     # business_id, item_mean (all rows)
    lookup: DataFrame         # user_id, business_id, stars, item_mean: one row per pair
    degrees: DataFrame | None = None     # user_id, n: rows of lookup, if written
    max_degree: int | None = None        # the highest n, if known
    by_item: DataFrame | None = None     # lookup laid out by item, if written


def prepare(train: DataFrame, dedupe: bool = True) -> Prepared:
    """Rows without a rating are left out."""
    rated = train.where(F.col(STARS).isNotNull())
    lookup = R.dedupe(rated) if dedupe else rated.select(USER, ITEM, F.col(STARS).cast("double").alias(STARS))
    means = R.item_means(rated).select(ITEM, "item_mean")
    return Prepared(R.user_means(rated).select(USER, "user_mean"), means, lookup.join(means, ITEM, "left").select(
        USER, ITEM, STARS, "item_mean"))


def request_status(requests: DataFrame, train: DataFrame | Prepared) -> DataFrame:
    """Requests with ``user_mean`` / ``item_mean`` (NULL when cold).

    Every request row is kept, duplicates included.
    """
    prep = train if isinstance(train, Prepared) else prepare(train, dedupe=False)
    return (requests.select(USER, ITEM)
            .join(prep.user_means, USER, "left")
            .join(prep.item_means, ITEM, "left"))


def candidates(warm: DataFrame, train: DataFrame, exclude_self: bool = False,
               degrees: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(user_id, business_id, neighbour, rating)``: one row per item the
    requesting user rated.  ``degrees(user_id, n)`` are the rated items of each
    user, if known.  ``keep`` names columns of both that are kept, those of the
    rated items as ``neighbour_mean`` for ``item_mean``."""
    there = [(c, c.replace("item", "neighbour")) for c in keep]
    rated = train.where(F.col(STARS).isNotNull()).select(
        USER, F.col(ITEM).alias("neighbour"), F.col(STARS).alias("rating"), *[F.col(c).alias(to) for c, to in there])
    out = salted_join(warm.select(USER, ITEM, *keep), rated, USER, degrees).select(
        USER, ITEM, "neighbour", "rating", *keep, *[to for _, to in there])
    if exclude_self:
        out = out.where(F.col("neighbour") != F.col(ITEM))
    return out


def pair_key(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.least(a, b), F.greatest(a, b)


def needed_pairs(cands: DataFrame, parts: int | None = None) -> DataFrame:
    """Distinct canonical item pairs ``(item_i <= item_j)`` the requests need; with
    ``parts`` dealt by ``item_i`` to so many partitions, as ``store_bucketed`` lays them."""
    i, j = pair_key(ITEM, "neighbour")
    pairs = cands.select(i.alias("item_i"), j.alias("item_j"))
    return (pairs if parts is None else pairs.repartition(parts, "item_i")).distinct()


def wanted_ratings(pairs: DataFrame, train: DataFrame, hubs: DataFrame | None = None) -> DataFrame:
    """``(user_id, business_id, stars, _hub)``: the ratings of the items that
    ``pairs`` name.  ``hubs(business_id)`` must hold an end of every pair;
    ``_hub`` marks its items.  By default those of ``item_i``."""
    rated = train.where(F.col(STARS).isNotNull()).select(USER, ITEM, F.col(STARS).cast("double").alias(STARS))
    hubs = (pairs.select(F.col("item_i").alias(ITEM)) if hubs is None else hubs.select(ITEM)).distinct()
    ends = pairs.select(F.explode(F.array("item_i", "item_j")).alias(ITEM)).distinct()
    items = ends.join(hubs.withColumn("_hub", F.lit(True)), ITEM, "left").select(
        ITEM, F.coalesce("_hub", F.lit(False)).alias("_hub"))
    return rated.join(items, ITEM)


def listed_rows(pairs: DataFrame, train: DataFrame, hubs: DataFrame | None = None,
                max_degree: int | None = None) -> DataFrame:
    """``(item_i, item_j, user_id, x, y)``: the co-ratings of all ``pairs`` and, of
    the items they name, some of other pairs.  See ``co_rating_rows``, which leaves
    those out."""
    limit = int(train.sparkSession.conf.get(EXPAND_CONF, str(DEFAULT_EXPAND_ITEMS)))
    rated = wanted_ratings(pairs, train, hubs)
    h, o = F.col("hub"), F.col("other")
    # of two hubs the smaller one lists the pair, so every pair is listed once
    once = ~F.col("other_hub") | (h <= o)

    def listed(df):
        left = df.where("_hub").select(USER, F.col(ITEM).alias("hub"), F.col(STARS).alias("_h"))
        right = df.select(USER, F.col(ITEM).alias("other"), F.col(STARS).alias("_o"), F.col("_hub").alias("other_hub"))
        i, j = pair_key(h, o)
        return left.join(right, USER).where(once).select(
            i.alias("item_i"), j.alias("item_j"), USER,
            F.when(h <= o, F.col("_h")).otherwise(F.col("_o")).alias("x"),
            F.when(h <= o, F.col("_o")).otherwise(F.col("_h")).alias("y"))

    if max_degree is not None and max_degree <= limit:
        return listed(rated)
    work = rated.groupBy(USER).agg((F.count(F.lit(1)) * F.count_if("_hub")).alias("_work"))
    heavy_users = work.where(F.col("_work") > limit * limit).select(USER)
    if heavy_users.isEmpty():
        return listed(rated)
    light = rated.join(work.where(F.col("_work") <= limit * limit).select(USER), USER, "left_semi")
    heavy = rated.join(heavy_users, USER, "left_semi")
    sides = [heavy.select(USER, F.col(ITEM).alias(item), F.col(STARS).alias(value))
             for item, value in (("item_i", "x"), ("item_j", "y"))]
    probe = salted_join(pairs, sides[0], "item_i").join(sides[1], ["item_j", USER])
    return listed(light).unionByName(probe.select("item_i", "item_j", USER, "x", "y"))


def mark(item: Column | str) -> Column:
    """An item's 16-bit mark: 65,536 of them, so a set of marks is bounded."""
    return F.shiftright(F.xxhash64(item), 48).cast("smallint")


def found_rows(pairs: DataFrame, train: DataFrame, hubs: DataFrame | None = None,
               max_degree: int | None = None, common: Callable = F.array_intersect) -> DataFrame:
    """What ``listed_rows`` gives, with far fewer rows of other pairs: a user's items
    go to each of their hubs as marks, the hub keeps the marks of the items it is
    paired with, and only for those are the user's ratings looked up.  A row of
    another pair is left where two items share a mark.  A hub paired with items of
    more than ``NEAR_MARKS`` marks keeps all.  ``pairs`` may be repeated, and may hold
    ``_first``: true only where ``item_i`` is a hub, which then lists the pair.
    ``common`` gives the marks that two sets share."""
    limit = int(train.sparkSession.conf.get(EXPAND_CONF, str(DEFAULT_EXPAND_ITEMS)))
    if max_degree is None:
        max_degree = train.groupBy(USER).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    rated = wanted_ratings(pairs, train, hubs).where(F.col(USER).isNotNull())
    probe = None
    if max_degree > limit:
        work = rated.groupBy(USER).agg((F.count(F.lit(1)) * F.count_if("_hub")).alias("_work"))
        heavy_users = work.where(F.col("_work") > limit * limit).select(USER)
        if not heavy_users.isEmpty():
            heavy = rated.join(heavy_users, USER, "left_semi")
            sides = [heavy.select(USER, F.col(ITEM).alias(item), F.col(STARS).alias(value))
                     for item, value in (("item_i", "x"), ("item_j", "y"))]
            probe = (salted_join(pairs.select("item_i", "item_j").distinct(), sides[0], "item_i").join(sides[1], ["item_j", USER])
                     .select("item_i", "item_j", USER, "x", "y"))
        rated = rated.join(work.where((F.col("_work") > 0) & (F.col("_work") <= limit * limit)).select(USER),
                           USER, "left_semi")
    i, j = F.col("item_i"), F.col("item_j")
    near = pairs.select(i.alias("_h"), mark(j).alias("_m"))
    if hubs is not None:       # either end may be the hub
        unknown = pairs.where("not _first") if "_first" in pairs.columns else pairs
        near = near.unionByName(unknown.select(j.alias("_h"), mark(i).alias("_m")))
    near = near.groupBy("_h").agg(F.collect_set("_m").alias("_near"))
    rated = rated.select(USER, ITEM, STARS, "_hub").repartition(USER)      # moved once for both uses
    # hubs first and by id: behind a hub lie itself, the larger hubs and all items that are none, so that every
    # pair is found once
    lists = rated.groupBy(USER).agg(F.sort_array(F.collect_list(
        F.struct((~F.col("_hub")).alias("late"), F.col(ITEM).alias("item"), F.col(STARS).alias("stars")))).alias("_r"))
    lists = lists.select(USER, "_r", F.transform("_r", lambda r: mark(r["item"])).alias("_marks"))
    sent = lists.select(USER, "_r", "_marks", F.explode("_r").alias("_e")).where("not _e.late").select(
        USER, F.col("_e.item").alias("_h"), F.col("_e.stars").alias("_x"),
        F.slice("_marks", F.array_position(F.col("_r.item"), F.col("_e.item")).cast("int"),
                F.size("_marks")).alias("_marks"))
    hits = F.when(F.size("_near") > NEAR_MARKS, F.col("_marks")).otherwise(common("_near", "_marks"))
    asked = sent.join(near, "_h").select(USER, "_h", "_x", hits.alias("_hits")).where(F.size("_hits") > 0)
    other = rated.select(USER, F.col(ITEM).alias("_o"), F.col(STARS).alias("_y"),
                         (~F.col("_hub")).alias("_late"), mark(ITEM).alias("_mark"))
    h, o = F.col("_h"), F.col("_o")
    first = h <= o
    low, high = pair_key(h, o)
    found = (asked.join(other, USER).where(F.array_contains("_hits", F.col("_mark")) & (F.col("_late") | first))
             .select(low.alias("item_i"), high.alias("item_j"), USER,
                     F.when(first, F.col("_x")).otherwise(F.col("_y")).alias("x"),
                     F.when(first, F.col("_y")).otherwise(F.col("_x")).alias("y")))
    return found if probe is None else found.unionByName(probe)


def co_rating_rows(pairs: DataFrame, train: DataFrame, hubs: DataFrame | None = None,
                   max_degree: int | None = None) -> DataFrame:
    """``(item_i, item_j, user_id, x, y)``: the ratings of every user who rated
    both items of a pair.  ``pairs`` are distinct and canonical, ``train`` holds
    one rating per (user, item).  ``hubs``: see ``wanted_ratings``; ``max_degree``
    is the largest number of items of a user, if known: no user is then looked
    for that cannot be there."""
    return (found_rows(pairs, train, hubs, max_degree).join(pairs, ["item_i", "item_j"])
            .select("item_i", "item_j", USER, "x", "y"))


def co_rated(pairs: DataFrame, train: DataFrame, hubs: DataFrame | None = None,
             max_degree: int | None = None) -> DataFrame:
    """``(item_i, item_j, n, sx, sy, sxy, sxx, syy, sad)`` of every co-rated pair of
    ``pairs`` (canonical, may be repeated) and of some others (``found_rows``)."""
    x, y = F.col("x"), F.col("y")
    sums = {"sx": x, "sy": y, "sxy": x * y, "sxx": x * x, "syy": y * y, "sad": F.abs(x - y)}
    return found_rows(pairs, train, hubs, max_degree).groupBy("item_i", "item_j").agg(
        F.count("x").alias("n"), *[F.coalesce(F.sum(v), F.lit(0.0)).alias(name) for name, v in sums.items()])


def with_means(pairs: DataFrame, found: DataFrame, item_means: DataFrame) -> DataFrame:
    """``pairs`` of items that both have a mean, with their ``mean_i`` and ``mean_j`` and,
    as one field ``_s`` that is empty for most, what ``found`` holds of them."""
    means = [item_means.select(F.col(ITEM).alias(f"item_{s}"), F.col("item_mean").alias(f"mean_{s}"))
             .where(F.col(f"mean_{s}").isNotNull()) for s in "ij"]
    packed = found.select("item_i", "item_j", F.struct(*[c for c in found.columns if c not in ("item_i", "item_j")]).alias("_s"))
    return pairs.join(means[0], "item_i").join(packed, ["item_i", "item_j"], "left").join(means[1], "item_j")


def pair_stats(pairs: DataFrame, train: DataFrame, item_means: DataFrame | None = None,
               hubs: DataFrame | None = None, max_degree: int | None = None) -> DataFrame:
    """Co-rating sums per pair: ``n, sx, sy, sxy, sxx, syy, sad``.

    ``x`` is the rating of ``item_i``, ``y`` of ``item_j``; ``sad`` is
    ``sum(|x - y|)``.  With ``item_means`` the pairs of items that both have a
    mean are kept even without co-raters (``n = 0``), and ``mean_i``,
    ``mean_j`` are carried along; without, only co-rated pairs appear.
    """
    # pairs must be unique as unordered pairs; they are put in canonical
    # order here (a projection, no shuffle)
    ci, cj = pair_key("item_i", "item_j")
    pairs = pairs.select(ci.alias("item_i"), cj.alias("item_j"))
    by_first_key(pairs.sparkSession)
    sums = co_rated(pairs, train, hubs, max_degree)
    if item_means is None:
        return pairs.join(sums, ["item_i", "item_j"])
    rows = with_means(pairs, sums, item_means)
    return rows.select("item_i", "item_j", *[F.coalesce(f"_s.{name}", F.lit(0).cast("long" if name == "n" else "double"))
                                             .alias(name) for name in SUMS], "mean_i", "mean_j")


def pearson(n: Column, sx: Column, sy: Column, sxy: Column, sxx: Column, syy: Column) -> Column:
    """Pearson from sums, 0 when either variance is 0.

    ``n*sxx - sx^2`` is exact for ratings in whole or half stars, however many
    (``moments.scatter``), so the zero-variance test needs no epsilon.
    """
    n = n.cast("double")
    vx = scatter(n, sx, sxx)
    vy = scatter(n, sy, syy)
    den = vx * vy
    return F.when(den <= 0, F.lit(0.0)).otherwise(
        (n * sxy - sx * sy) / F.sqrt(F.when(den > 0, den)))


def agreement(sad: Column) -> Column:
    """Mean of ``(5 - |x - y|) / 5`` over two co-raters."""
    return (F.lit(2 * MAX_STARS) - sad) / F.lit(2 * MAX_STARS)


def mean_gap(mean_i: Column, mean_j: Column) -> Column:
    return (F.lit(MAX_STARS) - F.abs(mean_i - mean_j)) / F.lit(MAX_STARS)


def similarity_rule(n: Column) -> Column:
    return (F.when(n >= 3, F.lit("pearson")).when(n == 2, F.lit("agreement"))
            .otherwise(F.lit("mean_gap")))


def weight_of_two() -> Column:
    """The weight of a pair with two co-raters or more."""
    n = F.col("n")
    return F.when(n >= 3, pearson(n, F.col("sx"), F.col("sy"), F.col("sxy"), F.col("sxx"), F.col("syy"))).when(
        n == 2, agreement(F.col("sad")))


def weight_expr() -> Column:
    return weight_of_two().otherwise(mean_gap(F.col("mean_i"), F.col("mean_j")))


def item_similarity(pairs: DataFrame, train: DataFrame, item_means: DataFrame | None = None,
                    hubs: DataFrame | None = None, max_degree: int | None = None,
                    canonical: bool = False) -> DataFrame:
    """``(item_i, item_j, n, rule, weight)`` for every given pair whose items both have
    training ratings, put in canonical order; ``canonical``: they are in it already.  Such
    pairs laid out by ``item_i`` move once, to the mean of ``item_j``; of co-ratings their
    number and weight moves.

    ``train`` holds one rating per (user, item); ``item_means`` of the mean-gap
    rule are those of ``train`` unless given (those of all rows, duplicates
    included, in ``predict``).
    """
    means = R.item_means(train) if item_means is None else item_means
    i, j = (F.col("item_i"), F.col("item_j")) if canonical else pair_key("item_i", "item_j")
    pairs = pairs.select(i.alias("item_i"), j.alias("item_j"))
    by_first_key(pairs.sparkSession)
    found = co_rated(pairs, train, hubs, max_degree).select("item_i", "item_j", "n", weight_of_two().alias("weight"))
    rows = with_means(pairs, found, means).withColumn(
        "n", F.coalesce("_s.n", F.lit(0).cast("long")))
    weight = F.when(F.col("n") >= 2, F.col("_s.weight")).otherwise(mean_gap(F.col("mean_i"), F.col("mean_j")))
    return rows.select("item_i", "item_j", "n", similarity_rule(F.col("n")).alias("rule"),
                       weight.cast("double").alias("weight"))


def item_similarity_by_counts(pairs: DataFrame, train: DataFrame, item_means: DataFrame | None = None) -> DataFrame:
    """``item_similarity`` in two steps: co-raters are counted from rater sets
    first, pairs with at most one are decided by their items' means, and ratings
    are looked up for the other pairs alone.  It writes the sets and the counts.
    """
    rated = train.where(F.col(STARS).isNotNull())
    means = (R.item_means(rated) if item_means is None else item_means).select(ITEM, "item_mean")
    by_first_key(pairs.sparkSession)
    # an item has at most as many rows as there are items
    counts = store_bucketed(R.rater_overlap(pairs, store(R.rater_chunks(rated), "rater-chunks")), "co-rater-counts",
                            "item_i", 0, 0)
    sides = [means.select(F.col(ITEM).alias(f"item_{s}"), F.col("item_mean").alias(f"mean_{s}")) for s in "ij"]
    few = counts.where("n <= 1").join(sides[0], "item_i").join(sides[1], "item_j")
    gap = few.select("item_i", "item_j", "n", F.lit("mean_gap").alias("rule"),
                     mean_gap(F.col("mean_i"), F.col("mean_j")).alias("weight"))
    return gap.unionByName(item_similarity(counts.where("n >= 2").select("item_i", "item_j"), train, means))


def weighted_candidates(cands: DataFrame, weights: DataFrame) -> DataFrame:
    """``cands`` with the weight of their pair.  What moves to the pairs are their
    two items once, and which of them is the requested one."""
    i, j = pair_key(ITEM, "neighbour")
    rest = [c for c in cands.columns if c not in (ITEM, "neighbour")]
    c = cands.select(*rest, i.alias("item_i"), j.alias("item_j"), (F.col(ITEM) <= F.col("neighbour")).alias("_first"))
    first, second = F.col("item_i"), F.col("item_j")
    ends = {ITEM: F.when(F.col("_first"), first).otherwise(second),
            "neighbour": F.when(F.col("_first"), second).otherwise(first)}
    return (c.join(weights.select("item_i", "item_j", "weight"), ["item_i", "item_j"])
            .select(*[ends[c].alias(c) if c in ends else c for c in cands.columns], "weight"))


def asked_of(cands: DataFrame, warm: DataFrame, weights: DataFrame) -> DataFrame:
    """The ``cands`` whose pair may be in ``weights``: each request of ``warm`` gets
    the marks of the items that its item has a weight with, so that other candidates
    need not move to the pairs.  A request of more than ``ASKED_MARKS`` keeps all."""
    i, j = F.col("item_i"), F.col("item_j")
    ends = weights.select(i.alias(ITEM), mark(j).alias("_m")).unionByName(weights.select(j.alias(ITEM), mark(i).alias("_m")))
    marks = ends.groupBy(ITEM).agg(F.collect_set("_m").alias("_m"))
    marks = marks.select(ITEM, F.when(F.size("_m") <= ASKED_MARKS, F.col("_m")).alias("_m"))
    asked = warm.select(USER, ITEM).join(marks, ITEM)
    return cands.join(asked, [USER, ITEM]).where(
        F.col("_m").isNull() | F.array_contains("_m", mark("neighbour"))).select(*cands.columns)


def weighted_requests(warm: DataFrame, prep: Prepared, rated: DataFrame, exclude_self: bool = False) -> DataFrame:
    """``(user_id, business_id, neighbour, rating, weight)``: the candidates of
    ``warm(user_id, business_id, item_mean)``.  They stay with their user: a pair
    with at most one co-rater is decided by the means that its candidate holds, and
    only the weights of the other pairs come to the candidates."""
    by_first_key(warm.sparkSession)
    cands = candidates(warm, prep.lookup, exclude_self, prep.degrees, keep=("item_mean",))
    # a rating without an item counts as one of the requested item, as its pair has that twice
    cands = cands.select(USER, ITEM, F.coalesce("neighbour", ITEM).alias("neighbour"), "rating", "item_mean",
                         F.when(F.col("neighbour").isNull(), F.col("item_mean")).otherwise(F.col("neighbour_mean"))
                         .alias("neighbour_mean"))
    i, j = pair_key(ITEM, "neighbour")
    wanted = cands.select(i.alias("item_i"), j.alias("item_j"), (F.col(ITEM) <= F.col("neighbour")).alias("_first"))
    st = co_rated(wanted, rated, warm.select(ITEM), prep.max_degree).where("n >= 2")
    weights = st.select("item_i", "item_j", weight_of_two().alias("weight"))
    asked = cands.select(USER, ITEM, "neighbour")
    if prep.degrees is not None:       # of written tables: the weights are found once
        weights = store(weights, "pair-weights")
        asked = asked_of(asked, warm, weights)
    # where they lie: what comes back then moves once
    known = weighted_candidates(asked.distinct(), weights)
    means = F.col("item_mean"), F.col("neighbour_mean")
    return cands.join(known, [USER, ITEM, "neighbour"], "left").select(
        USER, ITEM, "neighbour", "rating", F.coalesce("weight", mean_gap(*means)).cast("double").alias("weight"))


def top_neighbours(wc: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k heaviest neighbours per request.

    Ties are broken by the weight rounded to 9 digits (so float noise cannot
    reorder equal weights) and then by the neighbour id: a total order, so
    the result is deterministic.
    """
    w = Window.partitionBy(USER, ITEM).orderBy(F.round("weight", 9).desc(), F.col("neighbour").asc())
    return wc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def weighted_mean(top: DataFrame, empty_value: float = COLD_USER_VALUE) -> DataFrame:
    """``(user_id, business_id, cf_score)``: ``sum(w*r)/sum(|w|)``."""
    agg = top.groupBy(USER, ITEM).agg(F.sum(F.col("weight") * F.col("rating")).alias("num"),
                                      F.sum(F.abs(F.col("weight"))).alias("den"))
    return agg.select(USER, ITEM, F.when(F.col("den") == 0, F.lit(empty_value))
                      .otherwise(F.col("num") / F.when(F.col("den") != 0, F.col("den")))
                      .alias("cf_score"))


def predict(train: DataFrame | Prepared, requests: DataFrame, k: int = TOP_K,
            cold_user_value: float = COLD_USER_VALUE, exclude_self: bool = False,
            dedupe: bool = True, clip: bool = False) -> DataFrame:
    """Item-CF prediction for every request row.

    Returns ``(user_id, business_id, prediction, source)`` with ``source`` in
    ``cold_user`` / ``cold_item`` / ``cf``.  Means are taken over the raw
    training rows; the neighbour ratings over the de-duplicated ones
    (``max`` per pair) unless ``dedupe`` is False.
    """
    prep = train if isinstance(train, Prepared) else prepare(train, dedupe)
    status = request_status(requests, prep)
    if prep.degrees is not None:       # of written tables: four branches read the requests, which are found once
        status = store(status, "request-status")
    warm = (status.where(F.col("user_mean").isNotNull() & F.col("item_mean").isNotNull())
            .groupBy(USER, ITEM).agg(F.first("item_mean").alias("item_mean")))
    small_hash_joins(warm.sparkSession)
    rated = prep.lookup if prep.by_item is None else prep.by_item
    cands = weighted_requests(warm, prep, rated, exclude_self)
    scores = weighted_mean(top_neighbours(cands, k), cold_user_value)
    out = status.join(scores, [USER, ITEM], "left")
    um, im = F.col("user_mean"), F.col("item_mean")
    pred = (F.when(um.isNull(), F.lit(cold_user_value)).when(im.isNull(), um)
            .otherwise(F.coalesce(F.col("cf_score"), F.lit(cold_user_value))))
    if clip:
        pred = F.least(F.greatest(pred, F.lit(1.0)), F.lit(MAX_STARS))
    source = (F.when(um.isNull(), F.lit("cold_user")).when(im.isNull(), F.lit("cold_item"))
              .otherwise(F.lit("cf")))
    return out.select(USER, ITEM, pred.cast("double").alias("prediction"), source.alias("source"))
