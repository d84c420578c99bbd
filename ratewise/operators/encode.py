"""Attribute selection and one-hot encoding with a training vocabulary.

Item attributes are a string map.  An attribute key is *selected* when it
has at most ``MAX_VALUES`` distinct values and is present on at least
``MIN_COVERAGE`` of all items (items without attributes count in the
denominator).  Coverage is tested exactly, as ``n_items >= 0.2 * total``
in integers, not by adding up 1/total.

One-hot: a missing value is the category ``unk``; the categories seen in
the training frame are sorted and the first one is dropped; the column for
category v of attribute a is named ``a + v``, or ``a=v`` where another column
has that name in some case (``ab``, ``c`` and ``a``, ``bc`` would share one).
Requests reuse the training
columns: a category not seen in training (or the dropped first one) gives
all zeros, and a training column absent from the requests is all zeros.

Only bounded vocabularies reach the driver: the selected keys (a handful;
keys with more than ``MAX_VALUES`` values are never collected as values)
and at most ``MAX_VALUES + 1`` categories per selected key.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEM = "business_id"

# Fixed values of the attribute rule.
MAX_VALUES = 10          # at most this many distinct values
MIN_COVERAGE_NUM, MIN_COVERAGE_DEN = 1, 5   # present on >= 1/5 of all items
MISSING = "unk"


def attribute_pairs(items: DataFrame) -> DataFrame:
    """``(business_id, attr_key, attr_value)`` for every attribute entry."""
    return (items.where(F.col("attributes").isNotNull())
            .select(ITEM, F.explode("attributes").alias("attr_key", "attr_value")))


def attribute_profile(items: DataFrame) -> DataFrame:
    """Per key: distinct values, items having it, total items, coverage."""
    total = items.agg(F.count(F.lit(1)).alias("total_items"))
    per_key = (attribute_pairs(items).groupBy("attr_key")
               .agg(F.count_distinct("attr_value").alias("n_values"),
                    F.count_distinct(ITEM).alias("n_items")))
    # ``total`` is one row: a broadcast nested-loop join
    return (per_key.crossJoin(F.broadcast(total))
            .select("attr_key", F.col("n_values").cast("long"), F.col("n_items").cast("long"),
                    F.col("total_items").cast("long"),
                    (F.col("n_items") / F.col("total_items")).alias("coverage")))


def selected_attributes(items: DataFrame) -> DataFrame:
    prof = attribute_profile(items)
    return prof.where((F.col("n_values") <= MAX_VALUES)
                      & (F.col("n_items") * MIN_COVERAGE_DEN >= F.col("total_items") * MIN_COVERAGE_NUM))


def selected_keys(items: DataFrame) -> list[str]:
    """The selected keys, sorted.  Driver-side, because the set is bounded:
    every selected key covers >= 1/5 of the items, so there are at most
    5 x (average attributes per item) of them."""
    return sorted(r["attr_key"] for r in selected_attributes(items).select("attr_key").collect())


def item_attributes_wide(items: DataFrame, keys: list[str]) -> DataFrame:
    """One column per selected key, only for items that have attributes."""
    has = items.where(F.col("attributes").isNotNull() & (F.size("attributes") > 0))
    return has.select(ITEM, *[F.try_element_at("attributes", F.lit(k)).alias(k) for k in keys])


def named(column: str) -> Column:
    """The column of just that name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def fit_vocabulary(frame: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted categories per column (NULL -> ``unk``) seen in ``frame``.

    One small aggregation; each column's set is bounded because only
    attributes with at most ``MAX_VALUES`` values are encoded.
    """
    if not columns:
        return {}
    row = frame.agg(*[F.collect_set(F.coalesce(named(c), F.lit(MISSING))).alias(c)
                      for c in columns]).first()
    return {c: sorted(row[c]) for c in columns}


def onehot_names(vocab: dict[str, list[str]], drop_first: bool = True,
                 taken: tuple[str, ...] = ()) -> list[tuple[str, str, str]]:
    """``(column, category, output name)`` in output order.  No two names, nor one
    and a name of ``taken``, are alike in any case."""
    cells = [(c, v) for c in sorted(vocab) for v in (vocab[c][1:] if drop_first else vocab[c])]
    plain = Counter((c + v).lower() for c, v in cells)
    used = {t.lower() for t in taken} | {n for n, k in plain.items() if k == 1}
    out = []
    for c, v in cells:
        name = c + v
        if plain[name.lower()] > 1 or name.lower() in {t.lower() for t in taken}:
            name = f"{c}={v}"
            while name.lower() in used:
                name = "=" + name
            used.add(name.lower())
        out.append((c, v, name))
    return out


def onehot_columns(vocab: dict[str, list[str]], taken: tuple[str, ...] = ()) -> list[Column]:
    return [F.when(F.coalesce(named(c), F.lit(MISSING)) == F.lit(v), F.lit(1)).otherwise(F.lit(0))
            .cast("int").alias(name) for c, v, name in onehot_names(vocab, taken=taken)]


def onehot_transform(frame: DataFrame, vocab: dict[str, list[str]]) -> DataFrame:
    """Replace each encoded column by its dummy columns (training names)."""
    keep = [c for c in frame.columns if c not in vocab]
    return frame.select(*map(named, keep), *onehot_columns(vocab, tuple(keep)))
