"""Buckets of candidates, cut into pairs of blocks of bounded size.

A bucket is all ids under one key; those of one id are of no use.  A bucket of
more than ``block`` ids (or other units of size) is split by a hash of the id into blocks, and every pair
of blocks becomes a group of its own, so no pair of ids is lost, no group holds
more than about two blocks, and one hot key spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split(rows: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """``rows(key, id, ...)`` of the buckets in ``sizes(key, n)`` with ``grp``
    (bigint) naming the group; rows of buckets with ``n`` over ``block`` appear
    once per group they belong to."""
    hit = rows.join(sizes, "key")
    blocks = F.ceil(F.col("n") / block)
    keep = [F.col(c) for c in rows.columns]
    small = hit.where(F.col("n") <= block).select(*keep, F.col("key").alias("grp"))
    large = (hit.where(F.col("n") > block)
             .withColumn("_me", F.pmod(F.xxhash64(F.lit("block"), F.col("id")), blocks))
             .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
             .select(*keep, F.xxhash64("key", F.least("_me", "_other"), F.greatest("_me", "_other")).alias("grp")))
    return small.unionAll(large)


def shared(rows: DataFrame) -> DataFrame:
    """``(key, n)`` of the keys of ``rows(key, id)`` that two or more ids have;
    n counts the rows."""
    return (rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))
            .where("lo <> hi").select("key", "n"))


def stream(rows: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn(columns, starts)`` over whole groups.  Rows are dealt out and sorted
    by ``grp``; ``columns`` has the NumPy (or Arrow, for strings) columns of
    some complete groups and ``starts`` where each begins.  Only the last,
    unfinished group is carried from batch to batch."""
    names = rows.columns
    g = names.index("grp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def flush(parts: list[pa.RecordBatch]):
            t = pa.Table.from_batches(parts).combine_chunks()
            grp = t.column(g).to_numpy()
            starts = np.flatnonzero(np.r_[True, grp[1:] != grp[:-1]])
            cols = {n: t.column(i).combine_chunks() for i, n in enumerate(names)}
            yield from fn(cols, starts)

        for batch in batches:
            if not batch.num_rows:
                continue
            grp = batch.column(g).to_numpy()
            last = int(np.searchsorted(grp, grp[-1], "left"))
            if last or (kept and kept[-1].column(g)[-1].as_py() != grp[0]):
                yield from flush([*kept, batch.slice(0, last)] if last else kept)
                kept = []
            kept.append(batch.slice(last))
        if kept:
            yield from flush(kept)

    return rows.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, schema)


def bit_table(rows: DataFrame, col: str, size: int) -> np.ndarray:
    """``np.packbits`` of the table of ``size`` bits (a power of two) in which the
    last bits of each value of bigint ``col`` set one.  Tasks put the bits together
    to words of 64, so the driver gets ``size / 64`` rows at most."""
    at = F.col(col).bitwiseAND(size - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(63).cast("int"))
    words = (rows.groupBy(F.shiftright(at, 6).cast("int").alias("word"))
             .agg(F.bit_or(bit).alias("bits")).collect())
    table = np.zeros(size // 64, "<u8")
    for r in words:
        table[r.word] = r.bits & 0xFFFFFFFFFFFFFFFF
    return np.packbits(np.unpackbits(table.view(np.uint8), bitorder="little"))
