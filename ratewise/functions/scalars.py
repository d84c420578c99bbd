"""Row-level helpers, all built-in (JVM, codegen'd) expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def packed_list_len(c: Column | str) -> Column:
    """Length of a comma-packed list: ``"None"`` -> 0, otherwise the number
    of comma pieces (so ``""`` -> 1, ``"2015,2016"`` -> 2)."""
    c = _col(c)
    return F.when(c == F.lit("None"), F.lit(0)).otherwise(F.size(F.split(c, ","))).cast("double")


def json_field(c: Column | str, field: str, type_: str = "string") -> Column:
    """One top-level field of a JSON object held in a string column."""
    return F.from_json(_col(c), f"`{field}` {type_}").getField(field)


def map_size(c: Column | str) -> Column:
    """Number of entries of a map (0 for NULL maps)."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Round for stable comparison; ``+ 0.0`` turns ``-0.0`` into ``0.0``."""
    return (F.round(_col(c).cast("double"), digits) + F.lit(0.0)).cast("double")
