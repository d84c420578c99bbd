"""Fuzzy line deduplication by MinHash over character shingles.

Lines are cut at ``\\n`` and stripped; blank lines are never removed.  A line's
shingles are its runs of ``SHINGLE`` characters, lower-cased (a shorter line is
one shingle).  Signatures of ``BANDS * ROWS`` minima are cut into bands; lines
that share a band are candidates: at a similarity of 0.8 a pair is one with
probability 1 - (1 - 0.8^3)^12 > 0.9998.  Candidates are verified by the exact
Jaccard similarity of their shingle sets, and a distributed union-find joins
the verified links to classes.  The first line of a class, by doc_id and line
number, stays; all others go.

Copies of a line are one candidate.  Buckets with the same least line id are
verified together, as the bands of a class mostly are; a large one is cut into
pairs of blocks, and each group returns a spanning forest of its links.  Line ids are 64-bit hashes of the stripped line.

Results: a document is a distinct (doc_id, text); repeated rows are the same
document and keep the same lines.  A NULL doc_id sorts first and is a document
like any other.  NULL text and text of blank lines lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.buckets import bit_table, split, stream
from ratewise.llm.common import small_batches, spare, store, table
from ratewise.llm.components import components

SHINGLE, BANDS, ROWS = 8, 12, 3
SIMILARITY = 0.8
BLANK = " \t\r\f"           # stripped from lines
BLOCK_CHARS = 2_000_000
CHUNK = 1 << 17            # characters hashed at a time
TABLE_BITS = 1 << 22
SEEN = 1 << 19             # line ids a task remembers

_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(1, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_R = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    """Mixes the bits of ``x`` in place."""
    t = x >> np.uint64(30)
    x ^= t
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=t)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=t)
    return x


def shingles(lines: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lines, end to end, and where each line's
    begin."""
    pad = "\0" * size
    low = [x.lower() for x in lines]
    c = np.frombuffer((pad.join(low) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.fromiter(map(len, low), np.int64, len(low))
    at = np.cumsum(length + size) - length - size
    n = np.maximum(length - size + 1, 1)
    h, width = c.astype(np.uint64), 1
    while width < size:                       # size is a power of two
        far = h[width:] * np.uint64(pow(_R, width, 1 << 64))
        far += h[:-width]
        h = far
        width *= 2
    begin = np.cumsum(n) - n
    take = np.repeat(at - begin, n)
    take += np.arange(len(take))
    return _mix(h[take]), begin


def band_keys(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One row of band keys per line."""
    x = (h >> np.uint64(32)).astype(np.uint32)
    y = np.empty_like(x)
    low = np.empty((BANDS * ROWS, len(begin)), np.uint64)
    for j, (m, a) in enumerate(zip(_MULTIPLY, _ADD, strict=True)):
        np.multiply(x, m, out=y)
        y += a
        low[j] = np.minimum.reduceat(y, begin)
    low = low.reshape(BANDS, ROWS, len(begin))
    keys = np.zeros((BANDS, len(begin)), np.uint64)
    for r in range(ROWS):
        keys *= np.uint64(_R)
        keys += low[:, r]
        keys += np.arange(1, BANDS + 1, dtype=np.uint64)[:, None]
        _mix(keys)
    return np.ascontiguousarray(keys.T).view(np.int64)


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, lid) of every line; lid is NULL for blank
    lines, and a text without lines has one row with NULL line_no."""
    def line_id(line):
        line = F.btrim(line, F.lit(BLANK))
        return F.when(line != "", F.xxhash64(line))

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode_outer(
        F.transform(F.split("text", "\n"), line_id)).alias("line_no", "lid"))


def _line_texts(docs: DataFrame) -> DataFrame:
    return (docs.select(F.explode(F.split("text", "\n")).alias("line"))
            .select(F.btrim("line", F.lit(BLANK)).alias("line")).where("line <> ''")
            .select(F.xxhash64("line").alias("id"), "line"))


def _new_rows(batches: Iterator[pa.RecordBatch], wanted=None) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Lines not seen lately in this partition, some characters at a time."""
    seen = np.zeros(SEEN, np.int64)           # by the id's last bits; a forgotten id is only worked on again
    for batch in batches:
        ids, first = np.unique(batch.column(0).to_numpy(), return_index=True)
        new = seen[ids & (SEEN - 1)] != ids
        if wanted is not None:
            new &= wanted[ids & (TABLE_BITS - 1)]
        ids, fresh = ids[new], first[new]
        seen[ids & (SEEN - 1)] = ids
        if not len(fresh):
            continue
        texts = batch.column(1).take(pa.array(fresh))
        total = np.cumsum(pc.utf8_length(texts).to_numpy().astype(np.int64))
        lo = 0
        while lo < len(fresh):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + CHUNK, "right")))
            yield ids[lo:hi], texts.slice(lo, hi - lo).to_pylist()
            lo = hi


def _sign(batches):
    for ids, texts in _new_rows(batches):
        keys = band_keys(*shingles(texts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel()), pa.array(np.repeat(ids, BANDS))], names=["key", "id"])


def _texts(batches, bits):
    wanted = np.unpackbits(bits.value).view(bool)
    for ids, texts in _new_rows(batches, wanted):
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts, pa.string())], names=["id", "line"])


def similar(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs of sets (hashes, repeats allowed)
    with a Jaccard similarity of at least ``least``."""
    m = len(sets)
    values = np.concatenate(sets)
    order = np.argsort(values)
    values = values[order]
    value = np.cumsum(np.r_[False, values[1:] != values[:-1]])       # numbered from 0
    x = value * m + np.repeat(np.arange(m), [len(s) for s in sets])[order]
    x.sort()
    x = x[np.r_[True, x[1:] != x[:-1]]]
    value = x // m
    owner = x - value * m
    sizes = np.bincount(owner, minlength=m)
    many = np.bincount(value)[value] > 1                             # the others are in one set only
    value, owner = value[many], owner[many]
    by_set = np.argsort(owner, kind="stable")
    of = np.split(value[by_set], np.searchsorted(owner[by_set], np.arange(1, m)))
    mine = np.zeros(int(x[-1]) // m + 1, bool)
    waiting = np.ones(m, bool)
    edges = []
    for root in range(m):
        if not waiting[root]:
            continue
        waiting[root] = False
        queue = [root]
        while queue and waiting.any():
            at = queue.pop()
            mine[of[at]] = True
            both = np.bincount(owner[mine[value]], minlength=m)
            mine[of[at]] = False
            close = np.flatnonzero(waiting & (both >= least * (sizes[at] + sizes - both) - 1e-9))
            if len(close):
                edges += [(at, k) for k in close.tolist()]
                queue += close.tolist()
                waiting[close] = False
                left = waiting[owner]
                value, owner = value[left], owner[left]
    return edges


def alike(h: np.ndarray, begin: np.ndarray, left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Whether the Jaccard similarity of the shingle sets of lines ``left[k]``
    and ``right[k]`` is at least ``least``, for all pairs in one sort.  Sorting
    uses 43 bits of each hash; pairs within two shingles of the limit are
    decided again by all 64."""
    ends = np.r_[begin[1:], len(h)]
    n = ends - begin
    start = np.stack([begin[left], begin[right]], 1).ravel()
    size = np.stack([n[left], n[right]], 1).ravel()
    mark = np.arange(len(size), dtype=np.uint64)                  # its last bit is the side
    mark = mark >> np.uint64(1) << np.uint64(44) | mark & np.uint64(1)
    at = np.repeat(start - (np.cumsum(size) - size), size)
    at += np.arange(len(at))
    x = h[at]
    x &= np.uint64((1 << 43) - 1)
    x <<= np.uint64(1)
    x |= np.repeat(mark, size)
    x.sort()
    step = x[1:] ^ x[:-1]                     # 0: the same side again, 1: the other side
    pairs = size[::2] + size[1::2]
    first = np.cumsum(pairs) - pairs
    union = np.add.reduceat(np.r_[True, step > 1], first, dtype=np.int64)
    shared = np.add.reduceat(np.r_[True, step != 0], first, dtype=np.int64) - union
    over = shared - least * union
    out = over >= -1e-9
    for k in np.flatnonzero(np.abs(over) < 2):
        a, b = (np.unique(h[begin[i]:ends[i]]) for i in (left[k], right[k]))
        common = len(np.intersect1d(a, b, assume_unique=True))
        out[k] = common >= least * (len(a) + len(b) - common) - 1e-9
    return out


def _verify(cols, starts, least):
    """Every line is held against the first of its group; only groups in which
    some are not alike it are searched whole."""
    ids, lines = cols["id"].to_numpy(), cols["line"]
    length = np.cumsum(pc.utf8_length(lines).to_numpy().astype(np.int64))
    ends = np.r_[starts[1:], len(ids)]
    a, b = [], []
    g = 0
    while g < len(starts):                    # some groups at a time
        done = length[starts[g] - 1] if starts[g] else 0
        stop = max(g + 1, int(np.searchsorted(length[ends - 1], done + CHUNK, "right")))
        lo, hi = starts[g], ends[stop - 1]
        h, begin = shingles(lines.slice(lo, hi - lo).to_pylist())
        first = np.repeat(starts[g:stop], ends[g:stop] - starts[g:stop]) - lo
        other = np.flatnonzero(np.arange(hi - lo) != first)
        close = np.zeros(len(other), bool)
        step = max(1, (1 << 19) // max(1, int(np.diff(np.r_[begin, len(h)]).max())))
        for k in range(0, len(other), step):
            close[k:k + step] = alike(h, begin, first[other[k:k + step]], other[k:k + step], least)
        odd = np.unique(first[other[~close]])
        odd = odd[ends[np.searchsorted(starts, odd + lo)] - lo - odd > 2]      # two lines: decided
        plain = close & ~np.isin(first[other], odd)
        a.append(ids[lo + first[other[plain]]])
        b.append(ids[lo + other[plain]])
        for s in odd.tolist():
            e = ends[np.searchsorted(starts, s + lo)] - lo
            stops = np.r_[begin[s + 1:e], begin[e] if e < len(begin) else len(h)]
            edges = similar([h[x:y] for x, y in zip(begin[s:e], stops, strict=True)], least)
            a.append(ids[lo + s + np.array([x for x, _ in edges], np.int64)])
            b.append(ids[lo + s + np.array([y for _, y in edges], np.int64)])
        g = stop
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(least id, id) of the keys that two or more ids have, from rows sorted by
    key and id; of what came before only the last row and its bucket are known."""
    last_key = last_id = low = None
    told = False                              # whether the open bucket's least id is out
    for batch in batches:
        if not batch.num_rows:
            continue
        key, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if last_key is not None:
            key, ids = np.r_[last_key, key], np.r_[last_id, ids]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        lows = ids[starts]
        if low is not None:
            lows[0] = low
        size = np.diff(np.r_[starts, len(ids)])
        of = np.repeat(lows, size)
        later = np.r_[last_key is None, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])] & (ids != of)
        if last_key is not None:
            later[0] = False                  # the row carried over was told before
        has = np.add.reduceat(later, starts) > 0
        open_has = bool(has[-1]) or (told and len(starts) == 1)
        if told:
            has[0] = False
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[of[later], lows[has]]), pa.array(np.r_[ids[later], lows[has]])], names=["key", "id"])
        last_key, last_id, low, told = key[-1], ids[-1], lows[-1], open_has


def line_links(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Edges (a, b) between line ids that connect what the similarity connects."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = _line_texts(docs).select("id", "line").mapInArrow(_sign, "key bigint, id bigint")
    # each signature is made and dealt out once; sorted rows show which keys are shared
    wanted = store(rows.repartition("key").sortWithinPartitions("key", "id")
                   .mapInArrow(_buckets, "key bigint, id bigint").distinct(), "line-buckets")
    bits = spark.sparkContext.broadcast(bit_table(wanted, "id", TABLE_BITS))
    texts = (_line_texts(docs).mapInArrow(partial(_texts, bits=bits), "id bigint, line string")
             .groupBy("id").agg(F.max("line").alias("line")))
    members = store(wanted.join(texts, "id"), "line-texts")
    # written first: AQE can then split or broadcast the join of a bucket of any size
    sizes = store(members.groupBy("key").agg(F.sum(F.length("line")).alias("n")), "line-sizes")
    return stream(split(members, sizes, BLOCK_CHARS), partial(_verify, least=least), "a bigint, b bigint")


def removals(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, text_hash, n_lines (not blank), n_removed
    and removed, the numbers of its removed lines (from 0)."""
    lines = store(lines_of(docs).distinct(), "lines")
    roots = components(line_links(docs, least)).withColumnRenamed("node", "lid")
    spots = (lines.where("lid is not null").join(roots, "lid", "left")
             .select("doc_id", "text_hash", "line_no", F.coalesce("root", "lid").alias("root")))
    place = F.struct("doc_id", "line_no", "text_hash")
    # written first: AQE can then split or broadcast the join of a class of any size
    first = store(spots.groupBy("root").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
                  .select("root", "first"), "line-classes")
    gone = (spots.join(first, "root").where(~place.eqNullSafe(F.col("first")))
            .groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("line_no")).alias("removed")))
    all_docs = lines.groupBy("doc_id", "text_hash").agg(F.count("lid").alias("n_lines"))
    same = all_docs["doc_id"].eqNullSafe(gone["doc_id"]) & (all_docs["text_hash"] == gone["text_hash"])
    removed = F.coalesce(gone["removed"], F.array().cast("array<int>"))
    return all_docs.join(gone, same, "left").select(
        all_docs["doc_id"], all_docs["text_hash"], "n_lines",
        F.size(removed).cast("bigint").alias("n_removed"), removed.alias("removed"))


def _rebuild(batches):
    for batch in batches:
        *cols, gone = batch.columns           # the removed line numbers come last
        hit = np.flatnonzero(gone.is_valid().to_numpy(zero_copy_only=False))
        names = batch.schema.names[:-1]
        t = names.index("text")
        if len(hit):
            texts = cols[t].to_pylist()
            for k in hit.tolist():
                drop = set(gone[k].as_py())
                texts[k] = "\n".join([x for i, x in enumerate(texts[k].split("\n")) if i not in drop])
            cols[t] = pa.array(texts, cols[t].type)
        yield pa.RecordBatch.from_arrays(cols, names=names)


def dedup_lines(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with the removed lines cut out of ``text`` (and ``n_chars``, if
    there, set anew); a document that lost all its lines goes."""
    text_hash, removed = spare(docs, "line_hash", "removed_lines")
    gone = removals(docs, least).where("n_removed > 0")
    left = docs.withColumn(text_hash, F.xxhash64("text"))
    same = left["doc_id"].eqNullSafe(gone["doc_id"]) & (left[text_hash] == gone["text_hash"])
    joined = left.join(gone, same, "left").where(gone["n_lines"].isNull() | (gone["n_removed"] < gone["n_lines"])) \
        .select(*[left[c] for c in docs.columns], gone["removed"].alias(removed))
    out = joined.mapInArrow(_rebuild, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)
    return out


def op6_fuzzy_lines(spark, sf_dir: str) -> DataFrame:
    return removals(table(spark, sf_dir, "documents")).drop("text_hash")
