"""Spark session helpers.

On a cluster the session is created by the platform; ``configure`` only adds
settings that are unset.  ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins at run time (coalescing
# small shuffle partitions, splitting skewed ones); ANSI mode stays on so bad
# casts and divisions by zero fail loudly instead of producing NULLs.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # AQE sizes coalesced partitions by their *input* bytes; joins here often
    # expand a small input many times (requests -> candidates -> probes), so
    # small partitions are kept apart instead of being folded into one task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    conf = spark.conf
    for key, value in DEFAULTS.items():
        if conf.get(key, None) in (None, ""):
            conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir``.  Only in local mode, when it is unset
    (tests), a scratch folder is created, registered, and removed when the
    program ends; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if path:
        return path
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder shared by all "
                               "executors (a machine-local folder cannot hold checkpoints)")
        path = tempfile.mkdtemp(prefix="ratewise-ckpt-")   # local mode only (tests)
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_scope: ContextVar[str] = ContextVar("ratewise_scope", default="open")


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/ratewise-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of the current scope."""
    return f"{_folder(spark)}/{_scope.get()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block remove their shuffle files at their end.  No other plan
    reads those, and they would lie on the executors' disks until the driver collects
    its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed
    once, read (and pruned) by every branch of the plan that follows, and safe
    against the loss of the executors that computed it."""
    path = scratch_path(df.sparkSession, name)
    with own_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_tables: dict[str, list[str]] = {}      # names of the bucketed tables of a scope


def store_bucketed(df: DataFrame, name: str, key: str, most: int, rows: int) -> DataFrame:
    """``df`` written bucketed and sorted by ``key``, a file a bucket, and read
    back: joins and aggregations on the key take it as it lies, without an
    exchange.  ``most`` and ``rows`` are the rows of the key that has most of them
    and of all keys.  A bucket cannot be split, so where one key would fill more
    than a bucket's even share the table is stored plainly, and a join's exchange
    can be split by AQE."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if most * n > max(rows, 1):
        return store(df, name)
    table = f"ratewise_{uuid.uuid4().hex}"
    _tables.setdefault(_scope.get(), []).append(table)
    with own_shuffles(spark):
        (df.repartition(n, key).write.bucketBy(n, key).sortBy(key).format("parquet")
         .option("path", scratch_path(spark, name)).saveAsTable(table))
    return spark.table(table)


def _drop_tables(spark: SparkSession, scope: str) -> None:
    for table in _tables.pop(scope, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def remove_path(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What ``store`` writes inside the block goes to a folder of its own, which
    is removed at its end: a job that writes its result inside leaves nothing
    behind and touches no table of other jobs or of results still to be read."""
    token = _scope.set(uuid.uuid4().hex)
    try:
        yield
    finally:
        _drop_tables(spark, _scope.get())
        remove_path(spark, f"{_folder(spark)}/{_scope.get()}")
        _scope.reset(token)


def release(spark: SparkSession) -> None:
    """Remove everything that ``store`` wrote in this application: only when no
    result that reads it is still to be computed."""
    for scope in list(_tables):
        _drop_tables(spark, scope)
    remove_path(spark, _folder(spark))


def small_hash_joins(spark: SparkSession) -> None:
    """Let AQE build a hash table instead of sorting where every partition of
    the smaller side is measured to be small; all other joins sort and can spill."""
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, "16MB")


def by_first_key(spark: SparkSession) -> None:
    """Let a join on several keys take a side as it lies where it is dealt by some of
    them; only the other side then moves."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    if spark.conf.get(key, "true") == "true":
        spark.conf.set(key, "false")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ratewise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("RATEWISE_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
