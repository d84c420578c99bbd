"""Bad rating values, the command line's session, and what jobs leave behind."""

import os
import subprocess
import sys

import pytest

from ratewise.operators import cf
from ratewise.plans import jobs
from ratewise.session import checkpoint_dir
from ratewise.sources import files as FS

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TRAIN = "user_id,business_id,stars\nu1,A,5\nu1,B,x4\nu2,A,4\nu2,B,2\nu2,C,2\n"
GOOD = TRAIN.replace("u1,B,x4\n", "")


def _write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def _scores(spark, train, req):
    return sorted(map(tuple, cf.predict(train, req).select("user_id", "business_id", "prediction").collect()))


def test_bad_rating_stops_or_is_dropped(spark, tmp_path):
    bad, good = _write(tmp_path, "bad.csv", TRAIN), _write(tmp_path, "good.csv", GOOD)
    with pytest.raises(Exception, match="bad stars: x4"):
        FS.read_ratings(spark, bad).collect()
    assert FS.count_bad_rows(spark, bad, FS.RATINGS_SCHEMA) == 1
    dropped = FS.read_ratings(spark, bad, on_bad_rows="drop")
    req = spark.createDataFrame([("u1", "C")], "user_id string, business_id string")
    assert _scores(spark, dropped, req) == _scores(spark, FS.read_ratings(spark, good), req)


def test_null_ratings_do_not_weigh(spark):
    rows = [("u1", "A", 5.0), ("u2", "A", 4.0), ("u2", "B", 2.0), ("u2", "C", 2.0)]
    schema = "user_id string, business_id string, stars double"
    req = spark.createDataFrame([("u1", "C")], "user_id string, business_id string")
    with_null = spark.createDataFrame([*rows, ("u1", "B", None)], schema)
    assert _scores(spark, with_null, req) == _scores(spark, spark.createDataFrame(rows, schema), req)


def test_command_line_keeps_the_given_master(tmp_path):
    code = """
import sys
from ratewise import __main__ as m
from pyspark.sql import SparkSession
m.jobs.run_item_cf = lambda spark, *a: print("MASTER", spark.sparkContext.master)
m.main(["item-cf", "a", "b", "c"])
"""
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)
    assert "MASTER local[2]" in out.stdout, out.stderr[-2000:]


def test_jobs_remove_what_they_wrote(spark, tmp_path):
    good = _write(tmp_path, "good.csv", GOOD)
    req = _write(tmp_path, "req.csv", "user_id,business_id,stars\nu1,C,3\n")
    folder = checkpoint_dir(spark).removeprefix("file:") + f"/ratewise-{spark.sparkContext.applicationId}"
    train = FS.read_ratings(spark, good)
    live = jobs.item_cf(train, FS.read_requests(spark, req))        # lazy: reads what it stored
    before = set(os.listdir(folder)), set(os.listdir(f"{folder}/open"))
    jobs.run_item_cf(spark, good, req, str(tmp_path / "out"))
    assert (set(os.listdir(folder)), set(os.listdir(f"{folder}/open"))) == before
    assert FS.read_predictions(spark, str(tmp_path / "out")).count() == 1
    assert live.count() == 1                                         # another job has not removed its tables


def test_a_failing_job_removes_what_it_wrote(spark, tmp_path):
    good = _write(tmp_path, "good.csv", GOOD)
    folder = checkpoint_dir(spark).removeprefix("file:") + f"/ratewise-{spark.sparkContext.applicationId}"
    jobs.prepare_cf(FS.read_ratings(spark, good))
    before = set(os.listdir(folder))
    with pytest.raises(Exception, match="(?i)exist|bad stars"):
        jobs.run_item_cf(spark, good, str(tmp_path / "nowhere.csv"), str(tmp_path / "out"))
    assert set(os.listdir(folder)) == before
