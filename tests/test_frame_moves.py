"""The feature frames move their pairs once to the users and once to the items, and derive their inputs once."""
import pytest

from conftest import SF_SMALL
from ratewise.plans import catalog as C
from ratewise.plans import feature_frames as FF


@pytest.mark.parametrize("name", ["model_b_frame", "model_b_request_frame"])
def test_inputs_are_derived_once(spark, name):
    plan = C.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_partkey" not in plan and "o_custkey" not in plan


def test_pairs_move_once_to_each_side(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        inp = C._inputs(spark, SF_SMALL)
        df = FF.merged_training(inp, FF.fallback_profile(inp), None)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    lines = plan.splitlines()
    first = next(k for k, x in enumerate(lines) if "FileScan" in x)        # the pairs, under the joins' left sides
    assert "stars" in lines[first]
    moves = [x for x in lines[:first] if "Exchange hashpartitioning" in x]
    assert len(moves) == 2, plan
    assert df.columns[:3] == ["user_id", "business_id", "y"] and df.columns[-1] == "review_count"
