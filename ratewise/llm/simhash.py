"""SimHash near-duplicates by a generalised pigeonhole search.

Fingerprints: text lower-cased A-Z, words between ASCII white space, shingles
of three words (repeats count), XXH64 with seed 42; a bit is 1 if over half the
hashes have it.  Two fingerprints link at three or fewer differing bits.

Search: the 64 bits are cut into partitions, correlated bits together, and
partition i gets a threshold t_i >= -1 with sum(t_i + 1) = distance + 1.  Two
fingerprints within the distance differ in at most t_i bits of some partition.
Number of partitions and thresholds come from a dynamic program over estimated
costs: rows to probe plus candidate pairs, from bit statistics of all distinct
fingerprints.  Each fingerprint is indexed under its bits in every partition
and probes all values within t_i; what meets in a bucket is verified by the
whole distance.  A bucket returns a spanning forest of its verified links, not
its pairs, which is all that connected components need; large buckets are cut
into pairs of blocks (``buckets``).

Results: NULL text, empty text and text of white space alone have fingerprint
zero, linked like any other.  Copies share a fingerprint and are searched once.
A row with a NULL doc_id takes part by its fingerprint; component_id is the
smallest non-NULL doc_id of the component.  Repeated rows are repeated.
"""

from __future__ import annotations

from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.buckets import shared, split, stream
from ratewise.llm.common import by_document, row_key, spare, store, table
from ratewise.llm.components import components

WORDS, DISTANCE = 3, 3
BLOCK = 4096
#: Relative cost of a probe row (shuffled) and a candidate pair (compared).
PROBE_COST, PAIR_COST = 20.0, 1.0


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as a signed 64-bit integer."""
    import xxhash
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    n = max(1, len(tokens) - words + 1)
    if n == 1:
        raw = xxhash.xxh64_digest(joined, 42)
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        begin = [0, *(ends[:n - 1] + 1).tolist()]
        digest = xxhash.xxh64_digest
        raw = b"".join([digest(joined[s:e], 42) for s, e in zip(begin, ends[words - 1:].tolist(), strict=True)])
    rows = np.frombuffer(raw, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, 65536):
        counts += np.unpackbits(rows[lo:lo + 65536], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def _bits(fp: np.ndarray) -> np.ndarray:
    """One column per bit, the lowest first."""
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Count of fingerprints and the 64 x 64 counts of bits set together."""
    def count(batches):
        total = np.zeros((64, 64))
        for batch in batches:
            x = _bits(batch.column(0).to_numpy())
            for lo in range(0, len(x), 1 << 16):
                y = x[lo:lo + (1 << 16)].astype(np.float32)
                total += y.T @ y
            total_rows[0] += len(x)
        i, j = np.indices((64, 64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[i.ravel(), -1]), pa.array(np.r_[j.ravel(), -1]),
             pa.array(np.r_[total.ravel(), total_rows[0]])], names=["i", "j", "s"])

    total_rows = [0]
    sums = np.zeros((64, 64))
    n = 0
    for r in fps.select("fp").mapInArrow(count, "i bigint, j bigint, s double") \
            .groupBy("i", "j").agg(F.sum("s").alias("s")).collect():     # 4097 rows
        if r["i"] < 0:
            n = int(r["s"])
        else:
            sums[r["i"], r["j"]] = r["s"]
    return n, sums


def partition_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """64 bits in ``parts`` groups of nearly equal size; each grows from the
    bit with the least spread by the bit most correlated with it."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    free, out = list(np.argsort(sd, kind="stable")), []
    for k in range(parts):
        size = 64 // parts + (k < 64 % parts)
        group = [free.pop(0)]
        while len(group) < size:
            best = max(range(len(free)), key=lambda x: (corr[free[x], group].sum(), -x))
            group.append(free.pop(best))
        out.append(sorted(int(b) for b in group))
    return out


def thresholds(n: int, p: np.ndarray, parts: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """Least estimated cost and the t_i that give it."""
    costs = []
    for bits in parts:
        near = np.array([1.0])            # distribution of differing bits of two fingerprints
        for b in bits:
            q = 2 * p[b] * (1 - p[b])
            near = np.convolve(near, [1 - q, q])
        row = [0.0]
        for t in range(distance + 1):
            probes = sum(comb(len(bits), k) for k in range(t + 1))
            row.append(PROBE_COST * n * probes + PAIR_COST * n * n / 2 * near[:t + 1].sum())
        costs.append(row)
    best = {0: (0.0, [])}                 # by the sum of t_i + 1 so far
    for row in costs:
        new = {}
        for used, (cost, chosen) in best.items():
            for step, c in enumerate(row[:distance + 2 - used]):
                if used + step not in new or cost + c < new[used + step][0]:
                    new[used + step] = (cost + c, [*chosen, step - 1])
        best = new
    return best[distance + 1]


def plan(n: int, together: np.ndarray, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is probed."""
    p = np.diag(together) / max(n, 1)
    options = []
    for m in range(2, distance + 3):
        parts = partition_bits(n, together, m)
        cost, ts = thresholds(n, p, parts, distance)
        options.append((cost, [(bits, t) for bits, t in zip(parts, ts, strict=True) if t >= 0]))
    return min(options, key=lambda x: x[0])[1]


def _probe(batches, parts):
    """Rows (key, id, own) of each fingerprint: its own value in every
    partition, and the values within the threshold."""
    from itertools import combinations
    for batch in batches:
        fp = batch.column(0).to_numpy()
        x = _bits(fp)
        for k, (bits, t) in enumerate(parts):
            value = (x[:, bits].astype(np.int64) << np.arange(len(bits))).sum(1) | (k << 56)
            for size in range(t + 1):
                for flip in combinations(range(len(bits)), size):
                    mask = sum(1 << b for b in flip)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(value ^ mask), pa.array(fp), pa.array(np.full(len(fp), size == 0))],
                        names=["key", "id", "own"])


def forest(fp: np.ndarray, own: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links of one bucket."""
    a, b = [], []
    left = np.arange(len(fp))
    while len(left):
        edge, left = left[:1], left[1:]
        while len(edge) and len(left):
            step = max(1, (1 << 21) // len(left))
            found = np.zeros(len(left), bool)
            for lo in range(0, len(edge), step):
                e = edge[lo:lo + step]
                near = np.bitwise_count((fp[e][:, None] ^ fp[left][None, :]).view(np.uint64)) <= distance
                near &= own[e][:, None] | own[left][None, :]
                near &= ~found
                hit = near.any(0)
                a.append(fp[e[near.argmax(0)[hit]]])
                b.append(fp[left[hit]])
                found |= hit
            edge, left = left[found], left[~found]
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _verify(cols, starts, distance):
    fp, own = cols["id"].to_numpy(), cols["own"].to_numpy(zero_copy_only=False)
    sizes = np.diff(np.r_[starts, len(fp)])
    small = np.repeat(sizes <= 32, sizes)
    grp = np.repeat(np.arange(len(starts)), sizes)
    a, b = [], []
    for d in range(1, min(32, sizes.max(initial=0))):
        ok = (grp[d:] == grp[:-d]) & small[d:] & (own[d:] | own[:-d])
        i = np.flatnonzero(ok)
        i = i[np.bitwise_count((fp[i] ^ fp[i + d]).view(np.uint64)) <= distance]
        a.append(fp[i])
        b.append(fp[i + d])
    for s, size in zip(starts[sizes > 32], sizes[sizes > 32], strict=True):
        x, y = forest(fp[s:s + size], own[s:s + size], distance)
        a.append(x)
        b.append(y)
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))],
                                         names=["a", "b"])


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fps(fp)``, distinct -> edges (a, b) that connect what the distance
    connects."""
    n, together = bit_statistics(fps)
    parts = plan(n, together, distance)
    rows = fps.select("fp").mapInArrow(partial(_probe, parts=parts), "key bigint, id bigint, own boolean")
    return stream(split(rows, shared(rows), BLOCK), partial(_verify, distance=distance), "a bigint, b bigint")


def _components(docs: DataFrame, words: int, distance: int) -> DataFrame:
    """(doc_id, key, fp, root) of every row; key stands for doc_id and text."""
    rows = docs.select("doc_id", row_key("doc_id", "text").alias("key"), "text")
    fps = store(by_document(rows, lambda text, _: (fingerprint(text, words),), "fp bigint"), "fingerprints")
    distinct = store(fps.select("fp").distinct(), "distinct")
    joined = components(links(distinct, distance)).withColumnRenamed("node", "fp")
    return fps.join(joined, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id."""
    found = _components(docs, words, distance)
    # written first: AQE can then split or broadcast the join of a component of any size
    least = store(found.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least-ids")
    return found.join(least, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, or
    any row where all ids are NULL."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key"))
    key, = spare(docs, "row_key")
    keep = _components(docs, words, distance).groupBy("root").agg(first.alias("first")).select(
        F.col("first.key").alias(key))
    return docs.withColumn(key, row_key("doc_id", "text")).join(keep, key, "left_semi") \
        .dropDuplicates([key]).drop(key)


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
