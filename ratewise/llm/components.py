"""Connected components of an edge table: a distributed union-find.

Every partition first contracts its own edges to a forest with a local
union-find; then large-star and small-star steps alternate until the forest is
made of stars.  Nothing is collected: each step is a join and an aggregation,
and their results are written to the shared folder.  The least neighbours are
written before their join, so AQE can split or broadcast it and the centre of a
large star does not put all its edges into one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import store


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one partition as (node, smallest node of its local tree)."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (parent := up.get(root, root)) != root:
            root = parent
        while (parent := up.get(x, x)) != root:
            up[x] = root
            x = parent
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                up[max(a, b)] = min(a, b)
                up.setdefault(min(a, b), min(a, b))
    nodes = [x for x in up if find(x) != x]
    for lo in range(0, len(nodes), 100_000):
        part = nodes[lo:lo + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], names=["a", "b"])


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = store(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "large-low")
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = store(e.groupBy("a").agg(F.min("b").alias("m")), "small-low")
    return (e.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(low.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of bigint nodes, in any order, repeats and loops allowed
    -> ``(node, root)`` for every node that is not itself the smallest of its
    component.  Nodes without edges do not appear."""
    # written first: the edges mostly come out of Python, and two Python steps in a row would
    # take twice the workers, which then stay for the stages that follow
    e = store(edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a <> b"), "edges")
    e = store(e.mapInArrow(_contract, "a bigint, b bigint"), "forest")
    while True:
        shape = e.agg(F.count("*").alias("n"), F.count_distinct("a").alias("nodes")).first()
        if shape["n"] == shape["nodes"] and e.select("b").distinct().join(
                e.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        e = store(_small_star(store(_large_star(e), "large-star")), "star")
