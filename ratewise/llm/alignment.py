"""Alignment of two tokenizers' tokens by lockstep merging.

A document's tokens under a byte-level BPE vocabulary (A) and under a
SentencePiece vocabulary (B) cover the same bytes.  All documents of a batch are
merged at once: one NumPy state vector holds for each of them a pointer into A
and one into B.  Every step emits the link of the two tokens pointed at, emits a
cut where both end at the same byte, advances the pointer of the token that ends
first (both at a cut), and compacts the documents that are finished.  Links are
the pairs of tokens whose bytes overlap, cuts divide the tokens into groups.

A long document enters as several lanes, begun at offsets where tokens of both
sides end, so the number of steps follows the lanes, not the longest text.

Spark counts for each id pair the documents that hold it linked: distinct pairs
per document are kept packed in a written table, tasks add them up before the
shuffle.  The ``FREQUENT`` pairs of the highest counts, which most links have,
are broadcast; links of all other pairs are joined with their counts by a
shuffle.  The highest count of each A id is bounded by the vocabulary.

Results: NULL and empty texts, and texts that one side's tokens do not spell
(for instance with U+2581, which B reads as a space), have no tokens: all counts
are zero and the digest is ''.  Strings of special tokens are ordinary text.
Every row counts as a document, repeated ones and those with NULL doc_id too.
An empty table gives no rows; other columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import small_batches, store, table

BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
LANE = 256                   # A tokens of a lane, at least
PART_CHARS = 1 << 21         # characters aligned at a time
FREQUENT = 1 << 20           # pairs broadcast with their counts (24 bytes each)
GATHER = 1 << 22             # pairs added up in a task before they leave it


def file_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable
    ones for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """One tokenizer: ``raw`` is the bytes of each id, ``encode`` gives the ids of
    texts."""

    def __init__(self, raw: list[bytes], encode):
        self.raw, self.encode = raw, encode
        self.size = np.array([len(x) for x in raw], np.int64)
        width = max(map(len, digits := [str(i).encode() for i in range(len(raw))]))
        self.n_digits = np.array([len(d) for d in digits], np.int64)
        self.digits = np.frombuffer(b"".join(d.ljust(width + 1, b"\0") for d in digits), np.uint8).reshape(-1, width + 1)

    def spells(self, ids: np.ndarray, text: bytes) -> bool:
        raw = self.raw
        return b"".join([raw[i] for i in ids.tolist()]) == text


def byte_side(path: str) -> Side:
    """A: texts with a space before them, by a byte-level BPE file."""
    import public_tokenizers
    import tiktoken
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in entry): i for entry, i in said["model"]["vocab"].items()}
    for k, merge in enumerate(said["model"]["merges"]):
        joined = merge.replace(" ", "") if isinstance(merge, str) else "".join(merge)
        if said["model"]["vocab"][joined] != 256 + k:
            raise ValueError("merges must be in the order of their ids")
    raw = [b""] * (1 + max([*ranks.values(), *[t["id"] for t in said["added_tokens"]]]))
    for entry, i in ranks.items():
        raw[i] = entry
    coder = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Side(raw, lambda texts: [np.array(coder.encode_ordinary(" " + x), np.int64) for x in texts])


def piece_side(path: str) -> Side:
    """B: texts by a SentencePiece model, which puts a space before them."""
    import sentencepiece
    coder = sentencepiece.SentencePieceProcessor(model_file=path)
    raw = [bytes([int(p[3:5], 16)]) if coder.is_byte(i) else p.replace("▁", " ").encode()
           for i in range(coder.get_piece_size()) for p in [coder.id_to_piece(i)]]
    return Side(raw, lambda texts: [np.array(coder.encode(x, num_threads=1), np.int64) for x in texts])


@lru_cache(maxsize=2)
def sides(paths: tuple[str, str]) -> tuple[Side, Side]:
    return byte_side(paths[0]), piece_side(paths[1])


def lockstep(end_a: np.ndarray, end_b: np.ndarray, lane: int = LANE, doc_ends=()) -> tuple[np.ndarray, ...]:
    """Links and cuts (A and B indices of each) of two token rows over the same
    bytes, given where each token ends.  ``doc_ends`` are offsets that both rows
    are known to end tokens at, one a document."""
    starts = np.unique(np.r_[end_a[lane - 1::lane], np.asarray(doc_ends, np.int64)])
    in_a, in_b = np.searchsorted(end_a, starts), np.searchsorted(end_b, starts)
    common = (in_b < len(end_b)) & (end_b[np.minimum(in_b, len(end_b) - 1)] == starts)
    i = np.r_[0, in_a[common] + 1]
    j = np.r_[0, in_b[common] + 1]
    stop = np.r_[i[1:], len(end_a)]
    live = i < stop
    i, j, stop = i[live], j[live], stop[live]
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(i):
        links_a.append(i)
        links_b.append(j)
        a, b = end_a[i], end_b[j]
        cut = a == b
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        i, j = i + (a <= b), j + (b <= a)
        live = i < stop
        if not live.all():                  # compact the finished ones away
            i, j, stop = i[live], j[live], stop[live]
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) if x else none for x in (links_a, links_b, cuts_a, cuts_b))


def written_groups(a: Side, b: Side, ids_a, ids_b, cut_a, cut_b, last_b) -> tuple[np.ndarray, np.ndarray]:
    """The groups of all documents as text, ``a1,a2|b1;a3|b2``, and the bytes that
    each token takes there; ``cut_a``, ``cut_b`` flag tokens that end a group,
    ``last_b`` those that end a document."""
    n_a, n_b = len(ids_a), len(ids_b)
    ends_a, ends_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    at_a = np.arange(n_a) + np.r_[0, ends_b + 1][group_a]
    at_b = np.arange(n_b) + ends_a[group_b] + 1
    width = max(a.digits.shape[1], b.digits.shape[1])
    out = np.zeros((n_a + n_b, width), np.uint8)
    size = np.zeros(n_a + n_b, np.int64)
    for side, ids, at, cut, mark in ((a, ids_a, at_a, cut_a, ord("|")), (b, ids_b, at_b, cut_b, ord(";"))):
        out[at, :side.digits.shape[1]] = side.digits[ids]
        size[at] = side.n_digits[ids]
        out[at, side.n_digits[ids]] = np.where(cut, mark, ord(","))
    size += 1
    size[at_b[last_b]] -= 1
    return out[np.arange(width) < size[:, None]], size


def _align_texts(texts: list[str | None], a: Side, b: Side) -> dict[str, list]:
    """Columns of one result row per text."""
    n = len(texts)
    made = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    digest, pairs, times = [""] * n, [b""] * n, [b""] * n
    full = [k for k, x in enumerate(texts) if x]
    coded = [(k, x, y) for k, x, y in zip(full, a.encode([texts[k] for k in full]),
                                          b.encode([texts[k] for k in full]), strict=True)
             if a.spells(x, said := b" " + texts[k].encode()) and b.spells(y, said)]
    if not coded:
        return made | {"groups_sha256": digest, "pairs": pairs, "times": times}
    docs = np.array([k for k, _, _ in coded])
    ids_a, ids_b = np.concatenate([x for _, x, _ in coded]), np.concatenate([y for _, _, y in coded])
    n_a, n_b = np.array([len(x) for _, x, _ in coded]), np.array([len(y) for _, _, y in coded])
    end_a, end_b = np.cumsum(a.size[ids_a]), np.cumsum(b.size[ids_b])
    last_a, last_b = np.cumsum(n_a) - 1, np.cumsum(n_b) - 1
    link_a, link_b, at_a, at_b = lockstep(end_a, end_b, doc_ends=end_a[last_a])
    cut_a, cut_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    cut_a[at_a] = cut_b[at_b] = True
    owner = np.repeat(np.arange(len(docs)), n_a)
    made["n_a"][docs], made["n_b"][docs] = n_a, n_b
    made["n_groups"][docs] = np.bincount(owner[cut_a], minlength=len(docs))
    made["n_links"][docs] = np.bincount(owner[link_a], minlength=len(docs))

    text, size = written_groups(a, b, ids_a, ids_b, cut_a, cut_b, last_b)
    upto = np.r_[0, np.cumsum(size)[np.cumsum(n_a + n_b) - 1]]
    bits = int(len(a.raw) * len(b.raw) - 1).bit_length()
    key = owner[link_a].astype(np.uint64) << np.uint64(bits) | (
        ids_a[link_a] * len(b.raw) + ids_b[link_b]).astype(np.uint64)
    key, often = np.unique(key, return_counts=True)
    doc_of = (key >> np.uint64(bits)).astype(np.int64)
    pair = (key & np.uint64((1 << bits) - 1)).astype("<u8")
    first = np.r_[np.searchsorted(doc_of, np.arange(len(docs))), len(doc_of)]
    often = often.astype("<u4")
    text = text.tobytes()
    for d, k in enumerate(docs.tolist()):
        digest[k] = hashlib.sha256(text[upto[d]:upto[d + 1]]).hexdigest()
        pairs[k] = pair[first[d]:first[d + 1]].tobytes()
        times[k] = often[first[d]:first[d + 1]].tobytes()
    return made | {"groups_sha256": digest, "pairs": pairs, "times": times}


_KINDS = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
          "groups_sha256": pa.string(), "pairs": pa.binary(), "times": pa.binary()}


def _align(batches: Iterator[pa.RecordBatch], paths) -> Iterator[pa.RecordBatch]:
    a, b = sides(tuple(paths or map(file_path, (BYTE_FILE, PIECE_FILE))))
    for batch in batches:
        texts = batch.column(1)
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + PART_CHARS, "right")))
            got = _align_texts(texts.slice(lo, hi - lo).to_pylist(), a, b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), *[pa.array(got[c], t) for c, t in _KINDS.items()]],
                names=["doc_id", *_KINDS])
            lo = hi


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_a, n_b, n_groups,
    n_links, groups_sha256, and the packed distinct id pairs of its links (A id
    times the size of B plus B id, unsigned 64 bits) with how often each occurs
    (unsigned 32 bits)."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        partial(_align, paths=paths), f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                      "groups_sha256 string, pairs binary, times binary")


def _unpack(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a packed column end to end, and how many each row has."""
    parts = [np.frombuffer(x.as_py(), kind) for x in column]
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), np.array([len(x) for x in parts], np.int64)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, docs) counted within the task, at most ``GATHER`` at a time."""
    pair, docs, waiting, held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def merged():
        both = np.concatenate([pair, *waiting])
        weight = np.r_[docs, np.ones(len(both) - len(pair), np.int64)]
        order = np.argsort(both, kind="stable")
        both, weight = both[order], weight[order]
        first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, np.int64)
        return both[first], np.add.reduceat(weight, first) if len(first) else weight

    def out():
        for lo in range(0, len(pair), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[lo:lo + (1 << 16)]), pa.array(docs[lo:lo + (1 << 16)])], names=["pair", "docs"])

    for batch in batches:
        waiting.append(_unpack(batch.column(0), "<u8")[0].view(np.int64))
        held += len(waiting[-1])
        if held >= GATHER:
            pair, docs = merged()
            waiting, held = [], 0
            if len(pair) >= GATHER:
                yield from out()
                pair = docs = np.zeros(0, np.int64)
    pair, docs = merged()
    yield from out()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs): how many documents hold each id pair linked."""
    return aligned.select("pairs").mapInArrow(_add_up, "pair bigint, docs bigint") \
        .groupBy("pair").agg(F.sum("docs").alias("docs"))


def _score(batches: Iterator[pa.RecordBatch], known, width) -> Iterator[pa.RecordBatch]:
    """Rows with the sums over their known pairs, and the pairs left over."""
    pair_of, docs_of, best_of = known.value
    for batch in batches:
        get = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        pair, n = _unpack(get["pairs"], "<u8")
        pair, often = pair.view(np.int64), _unpack(get["times"], "<u4")[0].astype(np.int64)
        at = np.minimum(np.searchsorted(pair_of, pair), max(len(pair_of) - 1, 0))
        hit = pair_of[at] == pair if len(pair_of) else np.zeros(len(pair), bool)
        docs = np.where(hit, docs_of[at], 0) if len(pair_of) else np.zeros(len(pair), np.int64)
        best = hit & (docs == best_of[pair // width])
        ends = np.r_[0, np.cumsum(n)]

        def total(x):
            return np.diff(np.r_[0, np.cumsum(x)][ends])

        left = np.flatnonzero(~hit)
        offsets = pa.array(np.searchsorted(left, ends).astype(np.int32))
        keep = [c for c in get if c not in ("pairs", "times")]
        yield pa.RecordBatch.from_arrays(
            [*[get[c] for c in keep], pa.array(total(best * often)), pa.array(total(docs * often)),
             pa.ListArray.from_arrays(offsets, pa.array(pair[left])),
             pa.ListArray.from_arrays(offsets, pa.array(often[left]))],
            names=[*keep, "n_best", "count_sum", "rare", "rare_times"])


def linked(aligned: DataFrame, width: int, frequent: int = FREQUENT) -> DataFrame:
    """``aligned`` (a written table with a ``row`` number) with n_best and
    count_sum.  ``width`` is the number of B ids."""
    spark = aligned.sparkSession
    counts = store(pair_counts(aligned), "pair-counts")
    best = counts.select(F.expr(f"pair div {width}").alias("a"), "docs").groupBy("a").agg(F.max("docs").alias("best"))   # bounded by the vocabulary
    top = best.toPandas()
    best_of = np.zeros(int(top["a"].max()) + 1 if len(top) else 1, np.int64)
    best_of[top["a"].to_numpy(np.int64)] = top["best"].to_numpy(np.int64)
    n_pairs = counts.count()
    common = (counts if n_pairs <= frequent else counts.orderBy(F.desc("docs"), "pair").limit(frequent)).toPandas()
    common = common.sort_values("pair")
    known = spark.sparkContext.broadcast(
        (common["pair"].to_numpy(np.int64), common["docs"].to_numpy(np.int64), best_of))
    kept = [f for f in aligned.schema if f.name not in ("pairs", "times")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    scored = aligned.mapInArrow(
        partial(_score, known=known, width=width),
        f"{schema}, n_best bigint, count_sum bigint, rare array<bigint>, rare_times array<bigint>")
    if n_pairs <= frequent:
        return scored.drop("rare", "rare_times")
    scored = store(scored, "scored")
    rest = (scored.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("x"))
            .select("row", F.col("x.rare").alias("pair"), F.col("x.rare_times").alias("times"))
            .join(counts, "pair").withColumn("a", F.expr(f"pair div {width}")).join(best, "a")
            .groupBy("row").agg(F.sum(F.expr("if(docs = best, times, 0)")).alias("more_best"),
                                F.sum(F.col("docs") * F.col("times")).alias("more_sum")))
    return scored.drop("rare", "rare_times").join(rest, "row", "left").fillna(0, ["more_best", "more_sum"]) \
        .withColumn("n_best", F.col("n_best") + F.col("more_best")) \
        .withColumn("count_sum", F.col("count_sum") + F.col("more_sum")).drop("more_best", "more_sum")


def align(docs: DataFrame, paths: tuple[str, str] | None = None, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    aligned = store(alignments(docs, paths).withColumn("row", F.monotonically_increasing_id()), "aligned")
    width = len(sides(tuple(paths or map(file_path, (BYTE_FILE, PIECE_FILE))))[1].raw)
    return linked(aligned, width, frequent).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
