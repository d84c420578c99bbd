"""Structured Streaming: score request files as they arrive.

Request CSV files dropped into a folder are read as a file stream; every
micro-batch is scored with item-CF against a fixed training table and
written to ``<sink>/batch_id=<n>``.  A replayed batch (after a failure the
engine re-runs the last uncommitted epoch) overwrites its own folder, so the
output is exactly once; progress is tracked in the checkpoint location,
which defaults to the session's shared checkpoint folder.

What depends on the training table alone (means, one rating per pair, rated
items per user) is computed and written once, before the stream starts
(``jobs.prepare_cf``); each micro-batch is written once and scored from those
tables, and its plan lists only pairs with a requested item.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ratewise.operators import cf
from ratewise.session import checkpoint_dir, scratch_scope, store
from ratewise.sources.files import RATINGS_SCHEMA


def request_stream(spark: SparkSession, source_dir: str, schema: T.StructType = RATINGS_SCHEMA,
                   files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("header", True).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(source_dir)


def score_stream(train: cf.Prepared, requests: DataFrame, sink_dir: str,
                 checkpoint: str | None = None, available_now: bool = True,
                 processing_time: str | None = None, **predict_kw) -> StreamingQuery:
    spark = requests.sparkSession
    checkpoint = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    sink = sink_dir.rstrip("/")

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark):          # the source is read once, the plan reads the written batch
            pred = cf.predict(train, store(batch, "batch"), **predict_kw)
            pred.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    w = requests.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_scored(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.parquet(sink_dir).drop("batch_id")
