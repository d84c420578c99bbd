"""Benchmark decontamination by winnowing.

Words are runs of digits, a-z (after lower-casing A-Z) and all characters from
U+0080 on.  Every run of ``SIZE`` words shared by a document and a test item is
found: of each ``SIZE - GRAM + 1`` consecutive ``GRAM``-word hashes, which is
what ``SIZE`` words hold, the smallest is a fingerprint (all of equal smallest
ones are), so a shared run selects a fingerprint that both sides have.
Fingerprints of documents pass a bit table of those of the test items, are
joined with them, and each hit is extended: the words around it are compared
one by one, so equal hashes of different words change nothing.  Test items of
fewer than ``SIZE`` words are one window each; for their few lengths every
position of a document is a fingerprint.

Results: NULL text and text without words have n_words 0 and no hit; test items
of NULL text or without words never occur; a NULL item_id still marks words as
hit but is not counted as an item.  Copies of a text share one search; repeated
rows are repeated.  The bit table has ``TABLE_BITS`` entries whatever the size
of the benchmark; with more fingerprints it lets more candidates through to the
join, which stays exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.buckets import bit_table
from ratewise.llm.common import row_key, spare, store, table

SIZE, GRAM = 13, 5
LEAD = SIZE - GRAM
TABLE_BITS = 1 << 22
CHUNK = 1 << 18          # bytes hashed at a time

_A = np.arange(256)
#: Byte -> lower-cased byte of a word, or 0.
LOWER = np.where((_A >= 0x41) & (_A <= 0x5A), _A + 32, _A)
LOWER = np.where(((LOWER >= 0x30) & (LOWER <= 0x39)) | ((LOWER >= 0x61) & (LOWER <= 0x7A)) | (LOWER >= 0x80),
                 LOWER, 0).astype(np.uint8)
_P = 0x9E3779B97F4A7C15 | 1                      # odd: has an inverse modulo 2^64
_PI = pow(_P, -1, 1 << 64)
_Q = [pow(0xC2B2AE3D27D4EB4F, j, 1 << 64) for j in range(SIZE)]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _PI)):
            t = np.full(max(n, CHUNK + 4096), base, np.uint64)
            t[0] = 1
            _powers[k] = np.cumprod(t)
    return _powers[0], _powers[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased word bytes (0 between words), starts, ends and hashes of the
    words; a hash depends on the word's bytes alone."""
    low = LOWER[np.frombuffer(data, np.uint8)]
    is_word = np.zeros(len(low) + 2, bool)
    is_word[1:-1] = low > 0
    edge = np.flatnonzero(is_word[1:] != is_word[:-1])
    starts, ends = edge[::2], edge[1::2]
    hashes = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):                       # slices of whole words
        stop = max(k + 1, int(np.searchsorted(ends, starts[k] + CHUNK, "right")))
        at, end = int(starts[k]), int(ends[stop - 1])
        power, inverse = _power_tables(end - at + 1)
        total = np.zeros(end - at + 1, np.uint64)
        np.cumsum(low[at:end].astype(np.uint64) * power[:end - at], out=total[1:])
        s, e = starts[k:stop] - at, ends[k:stop] - at
        hashes[k:stop] = _mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        k = stop
    return low, starts, ends, hashes


def _gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    n = len(h) - size + 1
    if n <= 0:
        return h[:0]
    g = h[:n].copy()
    for j in range(1, size):
        g += h[j:j + n] * np.uint64(_Q[j])
    return _mix(g)


def fingerprints(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints of texts put end to end;
    ``doc`` numbers the text of each word."""
    g = _gram_hashes(h, GRAM)
    n = len(g) - LEAD                            # windows of SIZE words
    if n <= 0:
        return np.zeros(0, np.int64), g[:0]
    least = g[:n].copy()
    for j in range(1, LEAD + 1):
        np.minimum(least, g[j:j + n], out=least)
    whole = doc[:n] == doc[SIZE - 1:SIZE - 1 + n]
    chosen = np.zeros(len(g), bool)
    for j in range(LEAD + 1):
        chosen[j:j + n] |= (g[j:j + n] == least) & whole
    at = np.flatnonzero(chosen)
    return at, g[at]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def scan(texts: list[str | None], short: list[int], own: bool, bits: np.ndarray | None):
    """Word counts and hits of some texts.  A hit is (text number, gram size,
    word position, hash, words around it).  ``own``: texts are test items, so
    all their fingerprints are returned, those of short items as one gram."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.cumsum([0, *[len(p) + 1 for p in parts]])
    low, starts, ends, h = words_of(b" ".join(parts))
    doc = np.searchsorted(offsets, starts, "right") - 1
    counts = np.bincount(doc, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(counts)])
    found = [(GRAM, *fingerprints(h, doc))]
    for size in short:
        g = _gram_hashes(h, size)
        n = len(g)
        at = np.flatnonzero(doc[:n] == doc[size - 1:size - 1 + n])
        if own:
            at = at[counts[doc[at]] == size]
        found.append((-size, at, g[at]))
    hits = []
    for size, at, g in found:
        if bits is not None:
            ok = bits[(g & np.uint64(TABLE_BITS - 1)).astype(np.int64)]
            at, g = at[ok], g[ok]
        back, length = (LEAD, LEAD + SIZE) if size > 0 else (0, -size)
        for p, d, x in zip(at.tolist(), doc[at].tolist(), _signed(g).tolist(), strict=True):
            around = [low[starts[i]:ends[i]].tobytes().decode("utf-8", "replace")
                      if first[d] <= i < first[d + 1] else ""
                      for i in range(p - back, p - back + length)]
            hits.append((d, size, p - int(first[d]), x, around))
    return counts, hits


HIT = "struct<gram:int, pos:bigint, fp:bigint, words:array<string>>"
_HIT = pa.list_(pa.struct([("gram", pa.int32()), ("pos", pa.int64()), ("fp", pa.int64()),
                           ("words", pa.list_(pa.string()))]))


def _scan_batches(batches: Iterator[pa.RecordBatch], short, own, table_bits):
    import xxhash
    bits = None if table_bits is None else np.unpackbits(table_bits.value).view(bool)
    for batch in batches:
        lo = 0
        lengths = np.cumsum(np.asarray(batch.column(1).fill_null("").to_pandas().str.len(), np.int64))
        while lo < batch.num_rows:
            done = lengths[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(lengths, done + CHUNK, "right")))
            texts = batch.column(1).slice(lo, hi - lo).to_pylist()
            counts, hits = scan(texts, short, own, bits)
            by_text: dict[int, list] = {}
            for d, *hit in hits:
                by_text.setdefault(d, []).append(dict(zip(("gram", "pos", "fp", "words"), hit, strict=True)))
            keys = [xxhash.xxh3_128_hexdigest((t or "").encode("utf-8", "surrogatepass")) if k in by_text else None
                    for k, t in enumerate(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(counts, pa.int64()), pa.array(keys, pa.string()),
                 pa.array([by_text.get(k, []) for k in range(len(texts))], _HIT)],
                names=["id", "n_words", "text_key", "hits"])
            lo = hi


def _scanned(df: DataFrame, id_col: str, short, own, table_bits=None) -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), "text").mapInArrow(
        lambda batches: _scan_batches(batches, short, own, table_bits),
        f"id {kind}, n_words bigint, text_key string, hits array<{HIT}>")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated."""
    spark = docs.sparkSession
    lengths = _scanned(benchmark, "item_id", [], True).where(f"n_words > 0 and n_words < {SIZE}")
    short = sorted(r.n_words for r in lengths.select("n_words").distinct().collect())   # 12 values at most
    tests = store(_scanned(benchmark, "item_id", short, True)
                  .select("id", F.inline("hits")).distinct(), "test-fingerprints")
    bits = spark.sparkContext.broadcast(bit_table(tests, "fp", TABLE_BITS))
    found = store(_scanned(docs, "doc_id", short, False, bits), "document-fingerprints")

    hits = found.where("text_key is not null").select("text_key", F.inline("hits")).distinct()
    windows = (
        hits.join(tests.withColumnRenamed("words", "t_words").drop("pos"), ["gram", "fp"])
        .withColumn("lead", F.expr(f"if(gram > 0, {LEAD}, 0)"))
        .withColumn("size", F.expr(f"if(gram > 0, {SIZE}, -gram)"))
        .withColumn("at", F.explode(F.expr(
            "filter(sequence(0, lead), o -> slice(words, o + 1, size) = slice(t_words, o + 1, size)"
            " and not array_contains(slice(words, o + 1, size), ''))")))
        .select("text_key", "id", (F.col("pos") - F.col("lead") + F.col("at")).alias("start"),
                (F.col("pos") - F.col("lead") + F.col("at") + F.col("size")).alias("end")))
    spans = windows.groupBy("text_key", "start").agg(F.max("end").alias("end"))
    covered = spans.withColumn("before", F.expr(
        "max(end) over (partition by text_key order by start rows between unbounded preceding and 1 preceding)"))
    n_hit = covered.groupBy("text_key").agg(F.expr(
        "sum(greatest(0, end - greatest(start, coalesce(before, start))))").alias("n_hit"))
    items = (windows.where("id is not null").select("text_key", F.col("id").cast("string").alias("id")).distinct()
             .groupBy("text_key").agg(
                 F.count("*").alias("n_items"),
                 F.concat_ws(",", F.array_sort(F.collect_list("id"))).alias("items")))
    facts = n_hit.join(items, "text_key", "left")
    # texts without a candidate have no key and need no join
    rows = found.where("text_key is not null").join(facts, "text_key", "left").unionByName(
        found.where("text_key is null"), allowMissingColumns=True)
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        F.coalesce(F.expr("n_hit > 0 and 20 * n_hit >= n_words"), F.lit(False)).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones, whatever their doc_id.  Their keys are
    written first: few as they mostly are, the texts then need not move to the join."""
    key, = spare(docs, "text_key")
    texts = docs.select(row_key("text").alias("doc_id"), "text")
    bad = store(contamination(texts, benchmark).where("contaminated").select(F.col("doc_id").alias(key)).distinct(),
                "contaminated")
    return docs.withColumn(key, row_key("text")).join(bad, key, "left_anti").select(*docs.columns)


def op8_winnow(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"""regexp_extract_all(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+')"""
SQL = rf"""
with docs as (select doc_id, coalesce({_WORDS}, []) as w from documents),
 tests as (select item_id, {_WORDS} as w from benchmark where text is not null),
 sizes as (select distinct least(len(w), {SIZE}) as m from tests where len(w) > 0),
 test_windows as (select distinct item_id, least(len(w), {SIZE}) as m,
   unnest(list_transform(range(1, len(w) - least(len(w), {SIZE}) + 2),
     lambda i: array_to_string(w[i:i + least(len(w), {SIZE}) - 1], ' '))) as win
   from tests where len(w) > 0),
 doc_windows as (select doc_id, m, unnest(range(1, len(w) - m + 2)) as pos,
   unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as win
   from docs, sizes where len(w) >= m),
 hits as (select distinct doc_id, pos, d.m, item_id from doc_windows d join test_windows t using (m, win)),
 hit_words as (select doc_id, count(distinct p) as n_hit
   from (select doc_id, unnest(range(pos, pos + m)) as p from hits) group by doc_id),
 hit_items as (select doc_id, count(distinct item_id) as n_items,
   string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as items
   from hits group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
 sha256(coalesce(items, '')) as items_sha256,
 coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) as contaminated
from docs left join hit_words using (doc_id) left join hit_items using (doc_id)
"""
