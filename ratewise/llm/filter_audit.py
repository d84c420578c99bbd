"""Filter interaction audit by min-plus removal ranks.

Each document has a mask of the filters it fails.  For an order of the filters
the step that removes it is the least position of a filter it fails: with a mask
matrix C (0 where the filter fails, infinite where not) and a matrix P of the
filters' positions in each order (the inverse permutations), the ranks are the
min-plus product ``min over f of C[d, f] + P[f, o]``.  Scattering weighted
documents over (order, rank) gives what each step removes; the rest of the report
follows from those counts.

Documents with the same part and mask have the same ranks, so Spark first counts
them: a part has at most 2^filters weighted masks, whatever its size, and the
matrices of a part are computed where that one small row is.

A copy is found by a 128-bit hash of the text.  The least id of each repeated
text is written first, so the join that marks the later copies can be split or
broadcast by its measured size.

Results: NULL text is empty text and a copy of other empty texts; a NULL source
is part ''.  Only a smaller doc_id with the same text makes a copy: repeated rows
of one id are not copies of each other, and a row with NULL doc_id neither is nor
makes one, and has no label.  A document is good (toxic) if any label row of its
id says 1.  A part without documents does not exist; an empty table gives no
rows.  Other columns of any name are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import small_batches, store, table

NAMES = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5
UPPER, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
INNER = bytes(range(0x80, 0xC0))           # bytes of UTF-8 that begin no code point
LONG_TEXT = 4 << 20                        # words of longer texts are not listed at once
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    if len(text) <= LONG_TEXT:
        words = text.split()               # bytes split at \x20 and \x09-\x0D
        n, distinct = len(words), len(set(words))
    else:
        n, seen = 0, set()
        for m in _WORD.finditer(text):
            n += 1
            seen.add(m.group())
        distinct = len(seen)
    upper = len(text) - len(text.translate(None, UPPER))
    chars = len(text.translate(None, INNER))
    marked = len(text.translate(None, MARKS)) < len(text)
    return ((n < MIN_WORDS) | (100 * distinct < DISTINCT_PERCENT * n) << 1
            | (100 * upper > UPPER_PERCENT * chars) << 2 | marked << 3)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_128_digest
    for batch in batches:
        masks, keys = [], []
        for x in batch.column(2).cast(pa.binary()):
            text = x.as_py() or b""
            masks.append(text_mask(text))
            keys.append(xxh3_128_digest(text))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(keys, pa.binary())],
            names=["doc_id", "part", "mask", "key"])


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of every row of ``docs(doc_id, text, source)``: bit i
    of the mask is filter i of ``NAMES``."""
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    marked = store(docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
                   .mapInArrow(_mark, f"doc_id {id_type}, part string, mask int, key binary"), "marked")
    copies = store(marked.where("doc_id is not null").groupBy("key")
                   .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("key", "lo"),
                   "copied-texts")
    copy = F.when(F.col("doc_id") > F.col("lo"), F.lit(1 << 4)).otherwise(F.lit(0))
    return marked.join(copies, "key", "left").select("doc_id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def weighted(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each mask, and those labelled."""
    flags = store(labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).cast("int").alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int").alias("toxic"))
        .where("good + toxic > 0"), "label-flags")
    every = masked.groupBy("part", "mask").agg(F.count("*").alias("n"))
    said = masked.join(flags, "doc_id").groupBy("part", "mask").agg(
        F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    return every.join(said, ["part", "mask"], "left").fillna(0, ["good", "toxic"])


def ranks(mask: np.ndarray, position: np.ndarray) -> np.ndarray:
    """The step, from 1, that removes each mask in each order, by the min-plus
    product of masks (rows) and positions (filters x orders); filters + 1 where
    no step does."""
    n = len(position)
    cost = np.where(mask[:, None] >> np.arange(n) & 1, 0, n + 1)
    out = np.full((len(mask), position.shape[1]), n + 1)
    for f in range(n):
        np.minimum(out, cost[:, f, None] + position[f], out=out)
    return out


def report(mask: np.ndarray, weights: np.ndarray, orders: np.ndarray) -> dict[str, np.ndarray]:
    """(orders x steps) arrays of one part: ``weights`` has a row for all
    documents, for the good and for the toxic, and a column for each mask."""
    n_orders, n = orders.shape
    position = np.empty((n, n_orders), np.int64)
    position[orders, np.arange(n_orders)[:, None]] = np.arange(1, n + 1)
    step = ranks(mask, position)
    gone = np.zeros((len(weights), n_orders, n + 2), np.int64)
    for w, out in zip(weights, gone, strict=True):
        np.add.at(out, (np.arange(n_orders), step), w[:, None])
    removed = gone[0, :, 1:n + 1]
    fails = np.array([weights[0][(mask >> f & 1) == 1].sum() for f in range(n)])
    alone = np.array([weights[0][mask == 1 << f].sum() for f in range(n)])
    in_all = np.array([removed[np.arange(n_orders), position[f] - 1].sum() for f in range(n)])
    return {"kept": weights[0].sum() - np.cumsum(removed, 1), "removed": removed,
            "redundant": fails[orders] - removed, "unique_fails": alone[orders],
            "good_lost": gone[1, :, 1:n + 1], "toxic_lost": gone[2, :, 1:n + 1], "shapley": in_all[orders]}


FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _reports(batches: Iterator[pa.RecordBatch], names: str) -> Iterator[pa.RecordBatch]:
    orders = np.array(list(permutations(range(len(names)))))
    labels = np.repeat(["".join(names[f] for f in o) for o in orders], len(names))
    steps = np.tile(np.arange(1, len(names) + 1, dtype=np.int32), len(orders))
    for batch in batches:
        for part, rows in zip(batch.column(0), batch.column(1), strict=True):
            rows = rows.as_py()
            weights = np.array([[r[c] for r in rows] for c in ("n", "good", "toxic")], np.int64)
            got = report(np.array([r["mask"] for r in rows]), weights, orders)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.as_py()] * len(steps)), pa.array(labels), pa.array(steps),
                 *[pa.array(got[f].ravel()) for f in FIELDS]], names=["part", "filter_order", "step", *FIELDS])


def audit(weights: DataFrame, names: str = NAMES) -> DataFrame:
    """One row per part, order of the filters and step from ``weights(part, mask,
    n, good, toxic)``, in which a part has each mask once."""
    rows = weights.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    counts = ", ".join(f"{f} bigint" for f in FIELDS)
    return rows.mapInArrow(partial(_reports, names=names), f"part string, filter_order string, step int, {counts}")


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    marked = store(masks(table(spark, sf_dir, "documents")), "masks")
    return audit(weighted(marked, table(spark, sf_dir, "labels")))


SQL = rf"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
 lab as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good,
   max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id),
 least as (select t, min(doc_id) as lo from d group by t),
 f as (select d.doc_id, part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
   [len(w) < {MIN_WORDS}, 100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w),
    100 * len(regexp_extract_all(d.t, '[A-Z]')) > {UPPER_PERCENT} * length(d.t),
    regexp_matches(d.t, '[#$%&*|]'), coalesce(d.doc_id > lo, false)] as fails
   from d join least on d.t = least.t left join lab on d.doc_id = lab.doc_id),
 m as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by part, fails),
 x as (select unnest(range(1, 6)) as i),
 o as (select a.i as a, b.i as b, c.i as c, d.i as d, e.i as e, [a.i, b.i, c.i, d.i, e.i] as ord
   from x a, x b, x c, x d, x e where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
 s as (select ord, i as step, ord[i] as flt from o, x),
 r as (select part, ord, step, flt, n, good, toxic, fails[flt] as hit,
   len(list_filter(ord[1:step - 1], lambda z: fails[z])) > 0 as before,
   len(list_filter(fails, lambda z: z)) as n_fails from m, s),
 g as (select part, ord, step, flt, sum(case when not hit and not before then n else 0 end) as kept,
   sum(case when hit and not before then n else 0 end) as removed,
   sum(case when hit and before then n else 0 end) as redundant,
   sum(case when hit and n_fails = 1 then n else 0 end) as unique_fails,
   sum(case when hit and not before then good else 0 end) as good_lost,
   sum(case when hit and not before then toxic else 0 end) as toxic_lost
   from r group by part, ord, step, flt)
select part, array_to_string(list_transform(ord, lambda z: substr('{NAMES}', z, 1)), '') as filter_order,
 cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
 cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
 cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
 cast(sum(removed) over (partition by part, flt) as bigint) as shapley from g
"""
