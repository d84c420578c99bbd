"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ratewise.session import checkpoint_dir


BATCH_CONF = "ratewise.llm.batchBytes"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: computed
    once, pruned by later reads, and safe against lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what ``store`` wrote in this application (after its results were
    written; results are lazy and read those tables)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{checkpoint_dir(spark).rstrip('/')}/llm-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spare(df: DataFrame, *names: str) -> list[str]:
    """``names`` with as many underscores before them as keep them apart from the
    columns of ``df``, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(*cols: str):
    """A text that stands for the values of ``cols``: which are NULL, and 128 bits
    of hash (64 bits would meet by chance in tables of some 10^10 rows)."""
    nulls = [F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in cols]
    return F.concat(*nulls, F.hex(F.xxhash64(*cols)), F.lit("-"), F.hex(F.xxhash64(F.lit("again"), *cols)))


def held_out(doc_id="doc_id"):
    """The contract's fold: crc32 of the id as text, modulo 3, is 1 (a NULL id
    is not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def sampled(df: DataFrame, key: str, rows: int, total: int, seed: str) -> DataFrame:
    """About ``rows`` of the ``total`` rows of ``df``, chosen by a hash of
    ``key``: a bounded sample that needs no shuffle and never changes."""
    if total <= rows:
        return df
    cut = int(rows / total * (1 << 30))
    return df.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) < cut)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 16 MB (or ``ratewise.llm.batchBytes``): with texts
    of any length, what is in flight between the JVM and its Python workers stays
    small."""
    size = spark.conf.get(BATCH_CONF, str(16 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def keep_documents(df: DataFrame, fn: Callable, setup: Callable | None = None) -> DataFrame:
    """The rows of ``df`` whose ``fn(text, state)`` is true, all columns kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([bool(fn(x.as_py(), state)) for x in texts], pa.bool_()))

    small_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def fit_in_one_task(sample: DataFrame, order: list[str], fit: Callable) -> bytes | None:
    """``fit(table)`` over a bounded sample in one task, which a lost executor
    only repeats; the bytes it returns, or None for an empty sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([fit(pa.Table.from_batches(parts))], pa.binary())],
                                             names=["model"])

    rows = sample.coalesce(1).sortWithinPartitions(*order).mapInArrow(run, "model binary").collect()
    return bytes(rows[0].model) if rows else None


def by_document(df: DataFrame, fn: Callable, schema: str, setup: Callable | None = None) -> DataFrame:
    """``fn(text, state)`` for each row of ``df(key columns..., text)``; the
    result's values follow the key columns.  One text is held at a time besides
    the Arrow batch, and values leave in small batches."""
    keys = [c for c in df.columns if c != "text"]
    kept = [df.schema[c] for c in keys]
    values = [(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(schema)]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", " + schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for lo in range(0, batch.num_rows, 2000):
                part = texts.slice(lo, 2000)
                rows = [fn(x.as_py(), state) for x in part]
                arrays = [batch.column(batch.schema.get_field_index(c)).slice(lo, 2000) for c in keys]
                arrays += [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), values, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=keys + [n for n, _ in values])

    small_batches(df.sparkSession)
    return df.mapInArrow(run, out)
