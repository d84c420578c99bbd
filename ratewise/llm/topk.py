"""Exact top-k search by inner product with a pivot table.

A bounded sample gives up to ``PIVOTS`` pivots, each far from those before it.
The pivot table holds every vector's distances to all pivots, its squared norm,
the pivot next to it (its region) and its block, a part of that region of
bounded size.  For a query q and a vector x every pivot p gives the lower bound
``|d(q,p) - d(x,p)|`` of their distance; the maximum L of them bounds the score:
``<q,x> = (|q|^2 + |x|^2 - d(q,x)^2) / 2 <= (|q|^2 + |x|^2 - L^2) / 2``.

Search runs in two passes.  Each query is first held against its own block,
which gives it a threshold, the score of its k-th best there.  Then it visits the
blocks of all regions whose bound (from the least and largest distance of the
region's vectors to each pivot) reaches the threshold.  Inside a block
candidates are taken in the order of their bounds and evaluated until the next
bound is under the k-th best score.  Bounds carry a margin far above rounding,
and scores are integers computed exactly, so the result is that of brute force.

Queries and vectors meet in cells (a block and a share of the queries) that
Spark deals out; no task holds more than one block and one share.  Only the
pivots and the bounds of the regions, at most ``PIVOTS`` squared numbers, reach
the driver.

Results: a vector that is NULL or holds a NULL, NaN or infinite component takes
no part, nor does a NULL ``vec_id``.  Repeated rows (same id and vector) are one;
rows of one id with different vectors are queries and candidates each, and no
query meets a candidate of its own id.  Vectors of different length are not
compared; those of no component score 0.  Ties go to the smaller ``vec_id``.
Components and scores beyond 64 bits saturate.  An empty table or one without
queries gives an empty result; other columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.buckets import stream
from ratewise.llm.common import fit_in_one_task, sampled, small_batches, store, table

K, EVERY = 5, 50
PIVOTS = 32
SAMPLE = 1024                # vectors that pivots are chosen from
PIVOT_DIMS = 4096            # components of a pivot; the rest of it is zero
BLOCK_ROWS, BLOCK_VALUES = 1 << 14, 1 << 21
SHARE_ROWS, SHARE_VALUES = 1 << 12, 1 << 20
EXACT = float(1 << 50)       # squared norms under this: products and squared distances are exact in float64
LONG = 1 << 63


def quantised(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v): the distinct rows that take part, components as integers."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    scaled = F.transform(column, lambda x: F.floor(x.cast("double") * F.lit(256.0)))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull() & ~bad)
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled.alias("v"))
            .dropDuplicates(["vec_id", "v"]))


def _ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column end to end, and the length of each list."""
    return (column.flatten().to_numpy(zero_copy_only=False),
            np.diff(column.offsets.to_numpy().astype(np.int64)))


def _same_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their vectors as a matrix) for each vector length."""
    values, size = _ragged(column)
    begin = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        yield at, values[begin[at][:, None] + np.arange(d)]


def _pivots(sample: pa.Table) -> bytes:
    """Farthest-first pivots of the sample, zero-padded to one length."""
    rows = [np.array(v[:PIVOT_DIMS], np.float64) for v in sample.column("v").to_pylist()]
    width = max(map(len, rows))
    x = np.stack([np.pad(r, (0, width - len(r))) for r in rows])
    x = x[(x * x).sum(1) < EXACT]
    chosen = np.zeros((0, width))
    if len(x):
        far = ((x - x.mean(0)) ** 2).sum(1)
        while len(chosen) < PIVOTS and far.max() > 0:
            chosen = np.vstack([chosen, x[int(far.argmax())]])
            gap = ((x - chosen[-1]) ** 2).sum(1)
            far = np.minimum(far, gap) if len(chosen) > 1 else gap
    return np.float64([len(chosen), width]).tobytes() + chosen.tobytes()


def pivots(vectors: DataFrame, total: int) -> np.ndarray:
    """Pivot points, one a row, from a bounded sample of ``vectors(vec_id, v)``."""
    short = sampled(vectors, "vec_id", SAMPLE, total, "pivots").withColumn("v", F.slice("v", 1, PIVOT_DIMS))
    model = fit_in_one_task(short.limit(4 * SAMPLE), ["vec_id", "v"], _pivots)
    flat = np.frombuffer(model, np.float64) if model else np.zeros(2)
    return flat[2:].reshape(int(flat[0]), int(flat[1]))


def _distances(batches: Iterator[pa.RecordBatch], points: np.ndarray) -> Iterator[pa.RecordBatch]:
    p2 = (points * points).sum(1)
    for batch in batches:
        vecs = batch.column(1)
        n = len(vecs)
        norm, dist = np.zeros(n), np.zeros((n, len(points)))
        for at, ints in _same_length(vecs):
            x = ints.astype(np.float64)
            norm[at] = (x * x).sum(1)
            d = min(x.shape[1], points.shape[1])
            dist[at] = np.sqrt(np.maximum(norm[at][:, None] - 2 * (x[:, :d] @ points[:, :d].T) + p2, 0))
        near = dist.argmin(1) if len(points) else np.zeros(n, np.int64)
        region = np.where(norm < EXACT, near, -1)     # -1: too long for float64, never bounded
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), vecs, pa.array(norm), pa.array(list(dist), pa.list_(pa.float64())),
             pa.array(region.astype(np.int64))], names=["vec_id", "v", "norm", "dist", "region"])


def pivot_table(vectors: DataFrame, points: np.ndarray) -> DataFrame:
    """(vec_id, v, norm, dist, region, row) of ``vectors``, written: row is a
    number of its own for each vector."""
    small_batches(vectors.sparkSession)
    made = vectors.select("vec_id", "v").mapInArrow(
        partial(_distances, points=points),
        "vec_id bigint, v array<bigint>, norm double, dist array<double>, region bigint")
    return store(made.withColumn("row", F.monotonically_increasing_id()), "pivot-table")


def regions(pivot_rows: DataFrame, n_pivots: int) -> list:
    """One row per region: its rows and values, its largest norm, and the least
    and largest distance of its vectors to each pivot."""
    sides = [f(F.col("dist")[i]).alias(f"{name}{i}") for i in range(n_pivots)
             for name, f in (("lo", F.min), ("hi", F.max))]
    return pivot_rows.groupBy("region").agg(
        F.count("*").alias("n"), F.sum(F.size("v")).alias("n_values"), F.max("norm").alias("norm"), *sides).collect()


def _exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of integers of any size, as Python integers held to 64 bits."""
    full = [sum(a * b for a, b in zip(row, q.tolist(), strict=True)) for row in x.tolist()]
    return np.array([max(-LONG, min(LONG - 1, s)) for s in full], np.int64)


def _merge(ids, scores, more_ids, more_scores, k):
    ids, scores = np.r_[ids, more_ids], np.r_[scores, more_scores]
    best = np.lexsort((ids, -scores.astype(object) if scores.min(initial=0) == -LONG else -scores))[:k]
    return ids[best], scores[best]


class Block:
    """Candidates of one block: vectors of one length, their pivot distances
    (one row a pivot) and norms."""

    def __init__(self, ids, ints, norm, dist):
        self.ids, self.ints, self.norm = ids, ints, norm
        self.dist = np.ascontiguousarray(dist.T)
        self.floats = ints.astype(np.float64)
        self.plain = norm < EXACT

    def top(self, own, q, norm, dist, k, least):
        """Ids and scores of the best ``k`` candidates of another id than ``own``
        whose score is at least ``least`` (if not None), in bound order."""
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        other = self.ids != own
        huge = np.flatnonzero(other & ~self.plain) if norm < EXACT else np.flatnonzero(other)
        if len(huge):
            ids, scores = _merge(ids, scores, self.ids[huge], _exact_scores(self.ints[huge], q), k)
        if norm >= EXACT:
            return ids, scores
        low = np.zeros(len(self.ids))
        for mine, theirs in zip(dist, self.dist, strict=True):
            np.maximum(low, np.abs(theirs - mine), out=low)
        both = norm + self.norm
        bound = (both - low * low) / 2 + 1e-9 * both + 1
        open_ = other & self.plain
        if least is not None:
            open_ &= bound >= least
        at = np.flatnonzero(open_)
        at = at[np.argsort(-bound[at], kind="stable")]
        qf, lo, step = q.astype(np.float64), 0, 64
        while lo < len(at):
            limit = scores[-1] if len(scores) == k else None
            if limit is not None and bound[at[lo]] < limit:
                break                               # no later candidate can reach the k-th best
            some = at[lo:lo + step]
            got = (self.floats[some] @ qf).astype(np.int64)
            ids, scores = _merge(ids, scores, self.ids[some], got, k)
            lo, step = lo + step, 2 * step
        return ids, scores


def _cells(cols, starts, k):
    """Top lists of the queries of each cell against its candidates."""
    own, side = cols["vec_id"].to_numpy(), cols["query"].to_numpy(zero_copy_only=False)
    norm, least = cols["norm"].to_numpy(), cols["least"]
    ends = np.r_[starts[1:], len(own)]
    for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True):
        vecs, dists = cols["v"].slice(lo, hi - lo), cols["dist"].slice(lo, hi - lo)
        out = {"row": [], "ids": [], "scores": []}
        flat, size = _ragged(dists)
        dist = flat.reshape(len(size), -1) if len(flat) else np.zeros((len(size), 0))
        for at, ints in _same_length(vecs):
            here = at + lo
            cand = side[here] != 1                   # 0: candidate, 1: query, 2: both
            if not cand.any():
                continue
            block = Block(own[here[cand]], ints[cand], norm[here[cand]], dist[at[cand]])
            for i in np.flatnonzero(side[here] > 0).tolist():
                r = here[i]
                ids, scores = block.top(own[r], ints[i], norm[r], dist[at[i]], k, least[r].as_py())
                out["row"].append(cols["row"][r].as_py())
                out["ids"].append(ids.tolist())
                out["scores"].append(scores.tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["row"], pa.int64()), pa.array(out["ids"], pa.list_(pa.int64())),
             pa.array(out["scores"], pa.list_(pa.int64()))], names=["row", "ids", "scores"])


_TOP = "row bigint, ids array<bigint>, scores array<bigint>"


def _targets(batches, bounds, first, blocks, shares):
    """Queries with the blocks they visit, ``cell`` naming block and share."""
    for batch in batches:
        get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        norm, own, share = get["norm"].to_numpy(), get["block"].to_numpy(), get["share"].to_numpy()
        flat, size = _ragged(get["dist"])
        dist = flat.reshape(len(size), -1) if len(flat) else np.zeros((len(size), 0))
        least = get["least"].to_numpy(zero_copy_only=False).astype(np.float64)     # NULL is NaN
        take, cell = [], []
        for r, (top_norm, low, high) in bounds.items():
            gap = np.maximum(np.maximum(low - dist, dist - high), 0).max(1, initial=0)
            both = norm + top_norm
            reach = (both - gap * gap) / 2 + 1e-9 * both + 1
            visit = np.flatnonzero(~(reach < least) | (norm >= EXACT) if r >= 0 else np.ones(len(norm), bool))
            for b in range(first[r], first[r] + blocks[r]):
                go = visit[own[visit] != b]
                take.append(go)
                cell.append(b * shares + share[go])
        take = np.concatenate(take) if take else np.zeros(0, np.int64)
        cell = np.concatenate(cell) if cell else np.zeros(0, np.int64)
        for lo in range(0, len(take), 4096):
            part = batch.take(pa.array(take[lo:lo + 4096]))
            keep = [part.column(part.schema.get_field_index(n)) for n in ("row", "vec_id", "v", "norm", "dist", "least")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(cell[lo:lo + 4096])], names=["row", "vec_id", "v", "norm", "dist", "least", "grp"])


def search(vectors: DataFrame, is_query, k: int = K, column: str = "embedding") -> DataFrame:
    """The ``k`` best other vectors of every row of ``vectors(vec_id, column)``
    for which ``is_query`` (a Column over ``vec_id``) holds: query_id, rank,
    vec_id, score."""
    spark = vectors.sparkSession
    clean = store(quantised(vectors, column), "vectors")
    points = pivots(clean, clean.count())
    pivot_rows = pivot_table(clean, points)
    found = sorted(regions(pivot_rows, len(points)), key=lambda r: r["region"])
    blocks = {r["region"]: max(-(-r["n"] // BLOCK_ROWS), -(-r["n_values"] // BLOCK_VALUES)) for r in found}
    first = dict(zip(blocks, np.cumsum([0, *blocks.values()]).tolist()))
    bounds = {r["region"]: (r["norm"], np.array([r[f"lo{i}"] for i in range(len(points))]),
                            np.array([r[f"hi{i}"] for i in range(len(points))])) for r in found}

    def by_region(numbers):
        return F.element_at(F.create_map(*[F.lit(x) for r in numbers.items() for x in r]), F.col("region")) \
            if numbers else F.lit(0)

    spread = F.xxhash64(F.lit("block"), "vec_id", "v")
    placed = pivot_rows.withColumn(
        "block", (by_region(first) + F.pmod(spread, by_region(blocks))).cast("bigint")) \
        .withColumn("query", F.coalesce(is_query, F.lit(False)))

    small_batches(spark)
    nothing = F.lit(None).cast("bigint").alias("least")
    home = placed.select("row", "vec_id", "v", "norm", "dist", nothing, F.col("block").alias("grp"),
                         F.when(F.col("query"), 2).otherwise(0).cast("bigint").alias("query"))
    seeds = store(stream(home, partial(_cells, k=k), _TOP), "seeds")

    queries = placed.where("query")
    size = queries.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("v")), F.lit(0)).alias("n_values")).first()
    shares = max(1, -(-size["n"] // SHARE_ROWS), -(-size["n_values"] // SHARE_VALUES))
    least = F.when(F.size("scores") >= k, F.element_at("scores", -1)).alias("least")
    asking = queries.join(seeds.select("row", least), "row", "left").withColumn(
        "share", F.pmod(F.xxhash64(F.lit("share"), "row"), F.lit(shares)).cast("bigint"))
    visits = asking.select("row", "vec_id", "v", "norm", "dist", "least", "block", "share").mapInArrow(
        partial(_targets, bounds=bounds, first=first, blocks=blocks, shares=shares),
        "row bigint, vec_id bigint, v array<bigint>, norm double, dist array<double>, least bigint, grp bigint")
    every_share = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shares - 1).cast("bigint")))
    rows = visits.withColumn("query", F.lit(1).cast("bigint")).unionByName(
        placed.withColumn("share", every_share).select(
            "row", "vec_id", "v", "norm", "dist", nothing, (F.col("block") * shares + F.col("share")).alias("grp"),
            F.lit(0).cast("bigint").alias("query")))
    others = stream(rows, partial(_cells, k=k), _TOP)

    lists = seeds.unionByName(others).select("row", F.explode(F.arrays_zip("ids", "scores")).alias("x")) \
        .select("row", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score")).distinct()
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    best = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(queries.select("row", F.col("vec_id").alias("query_id")), "row") \
        .select("query_id", "rank", "vec_id", "score")


def op11_topk(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


SQL = f"""
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as c
  from embeddings where vec_id is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
 pairs as (select q.vec_id as query_id, x.vec_id, cast(coalesce(list_sum(list_transform(range(1, len(q.c) + 1),
   lambda i: q.c[i] * x.c[i])), 0) as bigint) as score
  from v q join v x on q.vec_id % {EVERY} = 0 and q.vec_id <> x.vec_id and len(q.c) = len(x.c)),
 ranked as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer)
   as rank, vec_id, score from pairs)
select * from ranked where rank <= {K}
"""
