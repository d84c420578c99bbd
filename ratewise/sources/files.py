"""File sources and sinks: CSV rating/request/prediction files and JSON-lines
entity records, always read with an explicit schema (no inference pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATINGS_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.DoubleType()),
])

PREDICTIONS_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
])

ITEM_SCHEMA = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
])

USER_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("review_count", T.DoubleType()),
    T.StructField("useful", T.DoubleType()),
    T.StructField("funny", T.DoubleType()),
    T.StructField("cool", T.DoubleType()),
    T.StructField("elite", T.StringType()),
    T.StructField("friends", T.StringType()),
    T.StructField("fans", T.DoubleType()),
    T.StructField("average_stars", T.DoubleType()),
    T.StructField("compliment_list", T.DoubleType()),
    T.StructField("compliment_note", T.DoubleType()),
])

REVIEW_SCHEMA = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("useful", T.DoubleType()),
    T.StructField("funny", T.DoubleType()),
    T.StructField("cool", T.DoubleType()),
])

TIP_SCHEMA = T.StructType([T.StructField("business_id", T.StringType())])

PHOTO_SCHEMA = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("label", T.StringType()),
])

CHECKIN_SCHEMA = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("time", T.MapType(T.StringType(), T.IntegerType())),
])

FALLBACK_COLUMNS = [f"{p}_{s}" for p in ("usr", "bns")
                    for s in ("avg", "std", "kurt", "skew", "max", "min")]
FALLBACK_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in FALLBACK_COLUMNS])


def _parsed(spark: SparkSession, path: str, schema: T.StructType):
    """Raw text columns, the typed column of each field, and whether a row has
    a value that its type cannot read."""
    names = [f.name for f in schema.fields]
    raw = (spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
           .option("header", True).option("mode", "PERMISSIVE").csv(path))
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    bad = F.lit(False)
    for n in names:
        bad = bad | (F.col(n).isNotNull() & typed[n].isNull())
    return raw, typed, bad


def read_csv(spark: SparkSession, path: str, schema: T.StructType, on_bad_rows: str = "fail") -> DataFrame:
    """CSV with a header line; columns are taken by position, extra columns
    are ignored and missing trailing ones are NULL.

    A value that its type cannot read stops the job (``on_bad_rows="fail"``) or
    takes its row out (``"drop"``; ``count_bad_rows`` tells how many)."""
    if on_bad_rows not in ("fail", "drop"):
        raise ValueError(f"on_bad_rows must be 'fail' or 'drop', not {on_bad_rows!r}")
    raw, typed, bad = _parsed(spark, path, schema)
    if on_bad_rows == "drop":
        return raw.where(~bad).select(*[c.alias(n) for n, c in typed.items()])

    def checked(name, col):
        broken = F.col(name).isNotNull() & col.isNull()
        message = F.concat(F.lit(f"{path}: bad {name}: "), F.col(name))
        return F.when(broken, F.raise_error(message).cast(schema[name].dataType)).otherwise(col).alias(name)

    return raw.select(*[checked(n, c) for n, c in typed.items()])


def count_bad_rows(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Rows that ``read_csv(..., on_bad_rows="drop")`` leaves out."""
    raw, _, bad = _parsed(spark, path, schema)
    return raw.where(bad).count()


def read_ratings(spark: SparkSession, path: str, schema: T.StructType = RATINGS_SCHEMA,
                 on_bad_rows: str = "fail") -> DataFrame:
    return read_csv(spark, path, schema, on_bad_rows).select("user_id", "business_id", "stars")


def read_requests(spark: SparkSession, path: str, schema: T.StructType = RATINGS_SCHEMA) -> DataFrame:
    """Pairs to score; a ``stars`` column, if present, is kept as the truth."""
    return read_csv(spark, path, schema)


def _json_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``(record, row, bad)`` of every line that is not blank; ``row`` has the
    schema's fields.

    Each line is parsed once, as the one element of an array: what follows a
    record on its line is then an error, as are a line that is no JSON object and
    a value that its type cannot read.  The parsed value passes through a
    generator, so filters on ``bad`` do not parse it again.
    """
    whole = T.StructType([T.StructField("r", T.ArrayType(schema)), T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.concat(F.lit('{"r":['), "record", F.lit("]}")), whole, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"})
    lines = spark.read.text(path).select(F.col("value").alias("record")).where(F.trim("record") != "")
    rows = lines.select("record", F.explode(F.array(parsed)).alias("p"))
    bad = (F.col("p._corrupt").isNotNull() | (F.coalesce(F.size("p.r"), F.lit(0)) != 1) | F.col("p.r")[0].isNull())
    return rows.select("record", F.col("p.r")[0].alias("row"), bad.alias("bad"))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, on_bad_rows: str = "fail") -> DataFrame:
    """JSON lines; fields that a record lacks are NULL, others are ignored, and
    blank lines are no records.

    A line that is no JSON object, or has a value that its type cannot read,
    stops the job (``on_bad_rows="fail"``, whatever columns are used) or is left
    out (``"drop"``; ``bad_json_rows`` returns and ``count_bad_json_rows`` counts
    those lines, ``quarantine_json`` writes them)."""
    if on_bad_rows not in ("fail", "drop"):
        raise ValueError(f"on_bad_rows must be 'fail' or 'drop', not {on_bad_rows!r}")
    rows = _json_rows(spark, path, schema)
    if on_bad_rows == "drop":
        good = rows.where("not bad")
    else:
        message = F.concat(F.lit(f"{path}: bad record: "), F.substring("record", 1, 200))
        good = rows.where(F.when(F.col("bad"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return good.select("row.*")


def bad_json_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``(record, reason)`` of the lines that ``read_json_lines(...,
    on_bad_rows="drop")`` leaves out; reason is ``value`` where a JSON object has
    a value of another type, and ``record`` for all other lines."""
    bad = _json_rows(spark, path, schema).where("bad")
    return bad.select("record", F.when(F.col("row").isNotNull(), F.lit("value")).otherwise(F.lit("record")).alias("reason"))


def count_bad_json_rows(spark: SparkSession, path: str, schema: T.StructType) -> int:
    return bad_json_rows(spark, path, schema).count()


def quarantine_json(spark: SparkSession, path: str, schema: T.StructType, bad_path: str,
                    mode: str = "overwrite") -> DataFrame:
    """The good rows of ``path``; its bad lines are written to ``bad_path`` as they
    are, so that they can be mended and read again."""
    bad_json_rows(spark, path, schema).select("record").write.mode(mode).text(bad_path)
    return read_json_lines(spark, path, schema, "drop")


def read_items(spark, path, on_bad_rows="fail"):
    return read_json_lines(spark, path, ITEM_SCHEMA, on_bad_rows)


def read_users(spark, path, on_bad_rows="fail"):
    return read_json_lines(spark, path, USER_SCHEMA, on_bad_rows)


def read_reviews(spark, path, on_bad_rows="fail"):
    return read_json_lines(spark, path, REVIEW_SCHEMA, on_bad_rows)


def read_tips(spark, path, on_bad_rows="fail"):
    return read_json_lines(spark, path, TIP_SCHEMA, on_bad_rows)


def read_photos(spark, path, on_bad_rows="fail"):
    return read_json_lines(spark, path, PHOTO_SCHEMA, on_bad_rows)


def read_checkins(spark, path, on_bad_rows="fail"):
    return read_json_lines(spark, path, CHECKIN_SCHEMA, on_bad_rows)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header line ``user_id,business_id,prediction`` (no spaces) and one
    part file per partition, written by the executors."""
    df.write.mode(mode).option("header", True).csv(path)


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_csv(df.select("user_id", "business_id", F.col("prediction").cast("double")), path, mode)


def read_predictions(spark: SparkSession, path: str,
                     schema: T.StructType = PREDICTIONS_SCHEMA) -> DataFrame:
    return read_csv(spark, path, schema)


def write_fallback(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one-row fallback profile, with named columns."""
    write_csv(df.select(*FALLBACK_COLUMNS).coalesce(1), path, mode)


def read_fallback(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, FALLBACK_SCHEMA)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
