"""Quality classifier: naive-Bayes support vectors.

A text's features are indicators of hashed n-grams: runs of 1 to 3 characters,
1 to 2 words, and 1 to 3 word shapes (case, digits, last character, length
class, whether the word repeats the one before).  Every indicator is scaled by
its log-count ratio between the two classes, counted over all labelled rows
that may be learned from but a fifth; vectors are scaled to length one and get a
constant.  A linear model of hinge loss is fitted on them by dual coordinate
descent, over at most about ``PER_CLASS`` rows of each class, chosen by a hash.
The fifth that was neither counted nor fitted sets the sigmoid that turns
margins into scores; its rows are weighted back to the classes' true sizes.

Results: NULL and empty texts have no feature and are scored by the constant
alone.  A doc_id with several labels counts with their rounded mean, a tie as 1;
NULL labels are ignored.  With one class only every score is that class, and
with no label 0.5.  Repeated rows are repeated.
"""

from __future__ import annotations

import io
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import by_document, fit_in_one_task, held_out, store, table

BUCKETS = 1 << 17
PER_CLASS = 3000
SMOOTH, COST, EPOCHS, TOLERANCE, BIAS = 1.0, 1.0, 60, 1e-3, 1.0
CHUNK = 1 << 20
_M = np.uint64(0x9E3779B97F4A7C15)


def _bucket(h: np.ndarray, seed: int) -> np.ndarray:
    h = (h ^ np.uint64(seed * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1)) * _M
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h >> np.uint64(64 - (BUCKETS - 1).bit_length())


def _grams(tokens: np.ndarray, orders: int, seed: int, out: np.ndarray) -> None:
    h = np.zeros(len(tokens), np.uint64)
    for n in range(1, orders + 1):
        if len(tokens) < n:
            return
        h = h[:len(tokens) - n + 1] * np.uint64(0x100000001B3) + tokens[n - 1:]
        out[_bucket(h, seed + n)] = True


@lru_cache(maxsize=1)
def _kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    chars = [chr(c) for c in range(0x110000)]
    return tuple(np.fromiter((test(c) for c in chars), bool, len(chars))
                 for test in (str.isspace, str.isupper, str.islower, str.isdigit))


def features(text: str | None) -> np.ndarray:
    """Sorted buckets of the n-grams that the text has."""
    found = np.zeros(BUCKETS, bool)
    text = text or ""
    lo = 0
    while lo < len(text):
        hi = min(len(text), lo + CHUNK)
        _add(np.frombuffer(text[max(0, lo - 200):hi].encode("utf-32-le", "surrogatepass"), np.uint32), found)
        lo = hi                                # the next piece repeats the last 200 characters
    return np.flatnonzero(found)


def _add(c: np.ndarray, found: np.ndarray) -> None:
    space, upper, lower, digit = _kinds()
    wide = c.astype(np.uint64)
    _grams(wide, 3, 0, found)
    word = ~space[c]
    edge = np.flatnonzero(np.diff(np.r_[False, word, False]))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return
    at = np.arange(len(c)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(c)]))
    mixed = np.where(word, (wide + np.uint64(1)) * _M ^ (at.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)),
                     np.uint64(0))
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed[~word] = 0
    words = np.add.reduceat(mixed, starts)
    _grams(words, 2, 10, found)

    def count(flags):
        return np.add.reduceat(flags[c].astype(np.int32), starts)

    size = ends - starts
    ups, lows, digits = count(upper), count(lower), count(digit)
    last = c[ends - 1]
    shape = (upper[c[starts]] + 2 * ((ups > 1) & (lows == 0)) + 4 * (digits > 0) + 8 * ((ups + lows) == 0)
             + 16 * np.minimum(size // 4, 7) + 128 * np.r_[False, words[1:] == words[:-1]])
    tail = np.where(upper[last] | lower[last] | digit[last], 0, last)
    _grams(shape.astype(np.uint64) << np.uint64(32) | tail.astype(np.uint64), 3, 20, found)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, y, text) of the rows that may be learned from, written once: the
    counts and the sample both read it.  The join is a shuffled one at every
    size, with the labels (a row a document) as its hash tables."""
    y = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
         .agg((F.avg("quality") >= 0.5).cast("int").alias("y")))
    rows = docs.where(~held_out()).select("doc_id", "text").join(y.hint("shuffle_hash"), "doc_id")
    return store(rows.select("doc_id", "y", "text"), "labelled")


def class_counts(rows: DataFrame) -> np.ndarray:
    """Rows with each bucket (and, last, all rows), by class."""
    def count(batches):
        total = np.zeros((BUCKETS + 1, 2), np.int64)
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total[features(text.as_py()), y] += 1
                total[-1, y] += 1
        at = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at, 0]),
                                          pa.array(total[at, 1])], names=["bucket", "n0", "n1"])

    out = np.zeros((BUCKETS + 1, 2), np.int64)
    for r in rows.select("y", "text").mapInArrow(count, "bucket int, n0 bigint, n1 bigint") \
            .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect():  # BUCKETS + 1 rows
        out[r.bucket] = r.n0, r.n1
    return out


def log_count_ratios(counts: np.ndarray) -> np.ndarray:
    p = counts[:-1].astype(float) + SMOOTH
    p /= p.sum(0)
    return np.log(p[:, 1] / p[:, 0])


def dual_coordinate_descent(rows, ratio: np.ndarray, seed: int = 42) -> np.ndarray:
    """Weights (the constant's last) of least w.w/2 + COST * sum of weighted hinge
    losses; ``rows`` are (buckets, y in {0, 1}, weight).  A row's dual variable
    stays between 0 and COST times its weight.  The passes end when no slope that
    may still move is steeper than TOLERANCE, or after EPOCHS."""
    w = np.zeros(BUCKETS + 1)
    data = []
    for at, y, weight in rows:
        x = ratio[at]
        norm = np.sqrt(x @ x)
        data.append((np.r_[at, BUCKETS], np.r_[x / norm if norm else x, BIAS], 2 * y - 1, COST * weight))
    alpha = np.zeros(len(data))
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        steepest = 0.0
        for k in rng.permutation(len(data)):
            at, x, s, cap = data[k]
            slope = s * (x @ w[at]) - 1
            new = min(max(0.0, alpha[k] - slope / (x @ x)), cap)
            if new != alpha[k]:
                steepest = max(steepest, abs(slope))
                w[at] += (new - alpha[k]) * s * x
                alpha[k] = new
        if steepest < TOLERANCE:
            break
    return w


def margin(at: np.ndarray, ratio: np.ndarray, w: np.ndarray) -> float:
    x = ratio[at]
    norm = np.sqrt(x @ x)
    return float((x @ w[at]) / norm if norm else 0.0) + BIAS * float(w[-1])


def sigmoid_fit(m: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic regression of y on margins."""
    a, b = 1.0, 0.0
    x = np.stack([m, np.ones_like(m)], 1)
    weight = weight / weight.mean()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g = x.T @ (weight * (p - y)) + 1e-2 * np.array([a - 1, b])
        h = x.T @ (x * (weight * p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
    return max(a, 1e-3), b


def _fit(t: pa.Table, ratio: np.ndarray, weights: list[float]) -> bytes:
    fit, rest = [], []
    for late, y, at in zip(*(t.column(c).to_pylist() for c in ("late", "y", "at")), strict=True):
        (rest if late else fit).append((np.array(at, np.int64), y, 1.0))
    w = dual_coordinate_descent(fit or rest, ratio)
    rest = rest or fit
    y = np.array([r[1] for r in rest], float)
    a, b = sigmoid_fit(np.array([margin(r[0], ratio, w) for r in rest]), y,
                       np.array([weights[r[1]] for r in rest]))
    out = io.BytesIO()
    np.savez_compressed(out, w=w, ratio=ratio, a=a, b=b)
    return out.getvalue()


class Model:
    def __init__(self, data: bytes):
        f = np.load(io.BytesIO(data))
        self.a, self.b = float(f["a"]), float(f["b"])
        self.w, self.ratio = f["w"], f["ratio"]

    def score(self, text: str | None) -> float:
        z = self.a * margin(features(text), self.ratio, self.w) + self.b
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


@lru_cache(maxsize=1)
def load(data: bytes) -> Model:
    return Model(data)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> bytes | float:
    """Model bytes, or the one score of all texts if there are not two classes.
    The late fifth of the rows, by a hash of the document, fits the sigmoid alone:
    it is neither counted nor fitted, unless the other rows lack a class."""
    rows = labelled(docs, labels)
    late = F.pmod(F.xxhash64(F.lit("late"), "doc_id"), F.lit(5)) == 0
    sizes = {(r.late, r.y): r["count"] for r in rows.groupBy(late.alias("late"), "y").count().collect()}
    n0, n1 = (sizes.get((False, y), 0) + sizes.get((True, y), 0) for y in (0, 1))
    if not n0 or not n1:
        return 1.0 if n1 else 0.0 if n0 else 0.5
    if len([k for k in sizes if not k[0]]) < 2:
        late = F.lit(False)
    counts = class_counts(rows.where(~late))
    ratio = log_count_ratios(counts)
    rate = F.when(F.col("y") == 1, min(1.0, per_class / n1)).otherwise(min(1.0, per_class / n0))
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = store(by_document(
        rows.where(place < rate).select("doc_id", "y", late.alias("late"), "text"),
        lambda text, _: (features(text).tolist(),), "at array<int>"), "quality-sample")
    weights = [max(1.0, n / per_class) for n in (n0, n1)]
    return fit_in_one_task(sample, ["doc_id", "y"], lambda t: _fit(t, ratio, weights)) or 0.5


def scores(docs: DataFrame, model: bytes | float) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def setup():
        return load(shared.value).score if isinstance(shared.value, bytes) else lambda text: shared.value

    return by_document(docs.select("doc_id", held_out().alias("held_out"), "text"),
                       lambda text, score: (score(text),), "score double", setup) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return scores(docs, fit(docs, labels))
