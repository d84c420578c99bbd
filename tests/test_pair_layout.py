"""What item-CF moves and leaves on disk: pairs laid out by their first item stay there,
candidates stay with their user, a written table leaves no shuffle files."""
import time
from functools import partial

import pytest
from pyspark.sql import functions as F

from ratewise.operators import cf
from ratewise.operators import ratings as R
from ratewise.plans import catalog as C
from ratewise.plans import jobs as J
from ratewise.session import store, store_bucketed
from test_cf_bruteforce import _joined_rows
from test_pair_moves import PAIR, RATING, _plan, _without_broadcast


def _ratings(spark):
    return spark.createDataFrame([(u, 1 + (u * 7 + k * 3) % 60, float(1 + (u + k * k) % 5)) for u in range(40)
                                  for k in range(12)], RATING)


def _laid(spark):
    pairs = spark.createDataFrame([(i, i + k) for i in range(1, 58) for k in (0, 3, 9, 27, 30, 41)], PAIR)
    return store_bucketed(pairs, "pairs", "item_i", 0, 0)


def _scans(plan, name):
    return [x for x in plan.splitlines() if "FileScan" in x and name in x]


def _bucketed_scans(plan, name):
    """Scans that read columns of this name by bucket, as they lie."""
    return sum("SelectedBucketsCount" in x for x in _scans(plan, name))


def _shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}


def test_a_written_table_leaves_no_shuffle_files(spark):
    df = _ratings(spark).groupBy("business_id").agg(F.sum("stars").alias("s"), F.count("*").alias("n"))
    before = _shuffle_files(spark)
    got = [store(df, "sums"), store_bucketed(df, "sums", "business_id", 1, 60)]
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert all(t.count() == 60 and t.agg(F.sum("n")).first()[0] == 480 for t in got)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_known_weights_move_once_to_their_candidates(spark):
    laid = J.prepare_cf(_ratings(spark))
    req = spark.createDataFrame([(u, b) for u in range(0, 42, 3) for b in range(0, 62, 5)], "user_id bigint, business_id bigint")
    plan = _without_broadcast(spark, lambda: _plan(cf.predict(laid, req)))
    assert not [x for x in plan.splitlines() if "Exchange" in x and "user_id" in x and "neighbour" in x.split("Exchange")[1]
                .split(")")[0]], plan
    plain = cf.predict(_ratings(spark), req)
    rows = [sorted((r.user_id, r.business_id, round(r.prediction, 9), r.source) for r in x.collect())
            for x in (cf.predict(laid, req), plain)]
    assert rows[0] == rows[1] and len(rows[0]) == 14 * 13


def test_neighbours_stay_with_their_user(spark, tmp_path):
    lines = [(u * 100 + k, 1 + (u * 7 + k * 3) % 60, float(1 + (u * 11 + k * k * 7) % 50)) for u in range(1, 45) for k in range(14)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(o, o // 100) for o, _, _ in lines], "o_orderkey bigint, o_custkey bigint").write.parquet(
        f"{tmp_path}/orders.parquet")
    d = str(tmp_path)
    plan = _without_broadcast(spark, lambda: _plan(C._top(spark, d)))
    ranked = plan[plan.index("Window [row_number"):]
    assert "Exchange" not in ranked[:ranked.index("Join")], plan
    train, _, cands = C._cf_inputs(spark, d)
    weights = cf.item_similarity(cf.needed_pairs(cands), train)
    want = cf.top_neighbours(cf.weighted_candidates(cands, weights))
    key = lambda df: sorted((r.user_id, r.business_id, r.neighbour, r.rating, round(r.weight, 9), r["rank"])
                            for r in df.collect())
    assert key(C._top(spark, d)) == key(want) and want.count() > 100


def test_common_raters_are_counted_of_needed_pairs_alone(spark):
    rated, pairs = store(_ratings(spark), "rated"), _laid(spark)
    got = R.rater_overlap(pairs, store(R.rater_chunks(rated), "chunks"))
    by = {}
    for r in rated.collect():
        by.setdefault(r.business_id, set()).add(r.user_id)
    found = {(r.item_i, r.item_j): r.n for r in got.collect()}
    assert found == {(r.item_i, r.item_j): len(by.get(r.item_i, set()) & by.get(r.item_j, set())) for r in pairs.collect()}
    assert _joined_rows(got) <= 2_000          # every two of a user's items before
    assert _bucketed_scans(_without_broadcast(spark, lambda: _plan(R.rater_overlap(pairs, store(R.rater_chunks(rated), "chunks")))),
                       "item_i") >= 1


@pytest.mark.parametrize("by_counts", [False, True])
def test_laid_out_pairs_move_to_one_end_alone(spark, by_counts):
    rated, pairs = store(_ratings(spark), "rated"), _laid(spark)
    fn = cf.item_similarity_by_counts if by_counts else partial(cf.item_similarity, canonical=True)
    plan = _without_broadcast(spark, lambda: _plan(fn(pairs, rated)))
    assert _bucketed_scans(plan, "item_i") >= 1, plan
    st = cf.pair_stats(pairs, rated, R.item_means(rated))
    want = {(r.item_i, r.item_j): (r.n, r["rule"], round(r.w, 9)) for r in st.select(
        "item_i", "item_j", "n", cf.similarity_rule(F.col("n")).alias("rule"), cf.weight_expr().alias("w")).collect()}
    got = {(r.item_i, r.item_j): (r.n, r["rule"], round(r.weight, 9)) for r in fn(pairs, rated).collect()}
    assert got == want and {x[1] for x in want.values()} == {"mean_gap", "agreement", "pearson"}
