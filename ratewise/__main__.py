"""Command line for the file-based jobs.

    python -m ratewise item-cf  TRAIN_CSV REQUESTS_CSV OUT_DIR
    python -m ratewise model-a  FOLDER REQUESTS_CSV OUT_DIR
    python -m ratewise hybrid   FOLDER REQUESTS_CSV OUT_DIR
    python -m ratewise feature-model FOLDER REQUESTS_CSV OUT_DIR [--trees N]

``FOLDER`` holds ``yelp_train.csv``, ``user.json``, ``business.json``,
``review_train.json``, ``tip.json``, ``photo.json`` and ``checkin.json``.
The session, its master and its memory come from the submit tool's settings (or
Spark's own defaults).  Predictions are written as CSV part files with
the header ``user_id,business_id,prediction``.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from ratewise.operators import model as M
from ratewise.plans import jobs
from ratewise.session import configure


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m ratewise")
    ap.add_argument("job", choices=["item-cf", "model-a", "hybrid", "feature-model", "fit-model-a",
                                    "fit-feature-model", "score-model-a", "score-feature-model"])
    ap.add_argument("inputs", help="training CSV (item-cf) or input folder")
    ap.add_argument("requests", nargs="?", help="request CSV (not for the fit- jobs)")
    ap.add_argument("out", help="output folder; for the fit- jobs that of the model")
    ap.add_argument("--model", help="folder of a fitted model (score- jobs)")
    ap.add_argument("--trees", type=int, default=None, help="number of boosted trees")
    ap.add_argument("--alternative", action="store_true", help="the feature model's alternative settings")
    args = ap.parse_args(argv)
    if (args.requests is None) != args.job.startswith("fit-"):
        ap.error("the fit- jobs take a folder and an output, all others requests too")
    if (args.model is None) == args.job.startswith("score-"):
        ap.error("--model goes with the score- jobs")
    params = dict(M.MODEL_B_ALTERNATIVE if args.alternative else M.MODEL_B_PARAMS)
    if args.trees:
        params["maxIter"] = args.trees

    spark = configure(SparkSession.builder.appName(f"ratewise {args.job}").getOrCreate())
    t0 = time.time()
    if args.job == "item-cf":
        jobs.run_item_cf(spark, args.inputs, args.requests, args.out)
    elif args.job == "model-a":
        jobs.run_model_a(spark, args.inputs, args.requests, args.out)
    elif args.job == "hybrid":
        jobs.run_hybrid(spark, args.inputs, args.requests, args.out)
    elif args.job == "fit-model-a":
        own = dict(M.MODEL_A_PARAMS) | ({"maxIter": args.trees} if args.trees else {})
        jobs.run_fit(spark, "a", args.inputs, args.out, own)
    elif args.job == "fit-feature-model":
        jobs.run_fit(spark, "b", args.inputs, args.out, params)
    elif args.job.startswith("score-"):
        which = "a" if args.job == "score-model-a" else "b"
        jobs.run_score(spark, which, args.inputs, args.model, args.requests, args.out)
    else:
        r = jobs.run_feature_model(spark, args.inputs, args.requests, args.out, params).first()
        if r is not None and r.n:
            print(f"RMSE {r.rmse:.6f} over {r.n} requests")
    print(f"Duration: {time.time() - t0:.2f} s")


if __name__ == "__main__":
    main()
