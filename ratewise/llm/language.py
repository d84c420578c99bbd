"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic-net
penalties and calibrated by a temperature.

Features: the text is lower-cased, everything but letters becomes one space,
and its n-grams of ``ORDERS`` characters are hashed to ``BUCKETS``; a document
is its (1 + log count) * idf vector, scaled to length one.  Document
frequencies count every row that may be learned from.  The fit reads at most
about ``PER_LANGUAGE`` rows of each language, chosen by a hash; a fifth of them
is left out of the fit and sets the temperature.

Results: a text that is NULL or has no letter is ``und`` with score 0, and so
is every text where there is nothing to learn from.  Rows with NULL lang are
predicted like the others.  Repeated rows are repeated.
"""

from __future__ import annotations

import io
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import by_document, fit_in_one_task, held_out, keep_documents, store, table

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
PER_LANGUAGE = 1000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.02, 0.001
UNKNOWN = "und"
MIN_SCORE = 0.5
CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(text: str | None) -> np.ndarray | None:
    """Count of n-grams in each bucket; None if the text has no letter."""
    if not text:
        return None
    total, some = np.zeros(BUCKETS, np.int64), False
    last = np.full(max(ORDERS), 32, np.uint32)             # what the next piece begins after
    for lo in range(0, len(text), CHUNK):
        c = np.frombuffer(text[lo:lo + CHUNK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[c]
        some = some or bool(letter.any())
        c = np.where(letter, c, np.uint32(32))
        c = np.concatenate([last, c, [np.uint32(32)]] if lo + CHUNK >= len(text) else [last, c])
        c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]]
        if len(c) < max(ORDERS):
            c = np.concatenate([np.full(max(ORDERS), 32, np.uint32), c])
        h = np.zeros(len(c), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            h = h[:len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1:]
            if n in ORDERS:
                x = (h ^ np.uint32(n * 0x9E3779B9 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                total += np.bincount((x ^ (x >> np.uint32(15))) & np.uint32(BUCKETS - 1), minlength=BUCKETS)
        last = c[-(max(ORDERS) - 1):]
    return total if some else None


def vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    n = counts(text)
    if n is None:
        return None
    at = np.flatnonzero(n)
    x = (1 + np.log(n[at])) * idf[at]
    return at, x / np.sqrt(x @ x)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts with a letter, and how many have each bucket."""
    def count(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                c = counts(text.as_py())
                if c is not None:
                    total += c > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1].astype(np.int32)), pa.array(np.r_[total[at], n])],
                                         names=["bucket", "df"])

    df, n = np.zeros(BUCKETS, np.int64), 0
    for r in docs.select("text").mapInArrow(count, "bucket int, df bigint") \
            .groupBy("bucket").agg(F.sum("df").alias("df")).collect():    # BUCKETS + 1 rows at most
        if r.bucket < 0:
            n = r.df
        else:
            df[r.bucket] = r.df
    return n, df


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, seed: int = 42) -> np.ndarray:
    """Weights (buckets x classes), most of them zero."""
    z = np.zeros((BUCKETS, classes))
    n = np.zeros((BUCKETS, classes))

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at, x, y = rows[k]
            zk, nk = z[at], n[at]
            w = weights(zk, nk)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(nk + g * g) - np.sqrt(nk)) / ALPHA
            z[at] = zk + g - sigma * w
            n[at] = nk + g * g
    return weights(z, n)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search of its log."""
    def loss(t):
        p = _softmax(logits / np.exp(t))[np.arange(len(y)), y]
        return -np.log(np.maximum(p, 1e-12)).mean()

    lo, hi, r = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _fit(t: pa.Table, idf: np.ndarray, names: list[str]) -> bytes:
    rows, calibrate = [], []
    for lang, late, at, x in zip(*(t.column(c).to_pylist() for c in ("lang", "late", "at", "x")), strict=True):
        (calibrate if late else rows).append((np.array(at, np.int64), np.array(x), names.index(lang)))
    w = ftrl(rows or calibrate, len(names))
    calibrate = calibrate or rows
    logits = np.array([x @ w[at] for at, x, _ in calibrate])
    out = io.BytesIO()
    np.savez_compressed(out, w=w.astype(np.float32), idf=idf, names=np.array(names, object).astype(str),
                        t=temperature(logits, np.array([y for *_, y in calibrate])))
    return out.getvalue()


class Model:
    def __init__(self, data: bytes):
        f = np.load(io.BytesIO(data))
        self.w, self.idf, self.t = f["w"].astype(float), f["idf"], float(f["t"])
        self.names = [str(x) for x in f["names"]]

    def predict(self, text: str | None) -> tuple[str, float]:
        v = vector(text, self.idf)
        if v is None:
            return UNKNOWN, 0.0
        p = _softmax(v[1] @ self.w[v[0]] / self.t)
        k = int(p.argmax())
        return self.names[k], float(p[k])


@lru_cache(maxsize=1)
def load(data: bytes | None) -> Model | None:
    return Model(data) if data else None


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> bytes | None:
    """Model bytes, learned from text and lang of the rows that are not held
    out; None if no such row has both a lang and a letter."""
    learn = docs.where(~held_out()).where("lang is not null and text is not null").select("doc_id", "lang", "text")
    sizes = {r.lang: r["count"] for r in learn.groupBy("lang").count().collect()}
    if not sizes:
        return None
    n, df = document_frequencies(learn)
    idf = np.log((1 + n) / (1 + df)) + 1
    rate = F.create_map(*[F.lit(x) for k, v in sorted(sizes.items())
                          for x in (k, min(1.0, per_language / v))])[F.col("lang")]
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    late = F.pmod(F.xxhash64(F.lit("late"), "doc_id"), F.lit(5)) == 0

    def one(text, idf):
        v = vector(text, idf)
        return ([], []) if v is None else (v[0].tolist(), v[1].tolist())

    sample = store(by_document(
        learn.where(place < rate).select("doc_id", "lang", late.alias("late"), "text"),
        one, "at array<int>, x array<double>", lambda: idf).where("size(at) > 0"), "language-sample")
    names = sorted(sizes)
    return fit_in_one_task(sample, ["doc_id", "lang"], lambda t: _fit(t, idf, names))


def predict(docs: DataFrame, model: bytes | None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def one(text, model):
        return model.predict(text) if model else (UNKNOWN, 0.0)

    return by_document(docs.select("doc_id", held_out().alias("held_out"), "text"), one,
                       "lang_pred string, score double", lambda: load(shared.value))


def keep(docs: DataFrame, model: bytes | None, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without those of unknown language or a score under ``min_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return keep_documents(docs, lambda text, m: m is not None and m.predict(text)[1] >= min_score,
                          lambda: load(shared.value))


def op1_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))
