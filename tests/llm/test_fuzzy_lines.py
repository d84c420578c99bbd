import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import fuzzy_lines as L

SF = "/root/testdata/sf0.001"
STRIP = " \t\r\f"


def grams(line):
    line = line.lower()
    return {line[i:i + 8] for i in range(max(1, len(line) - 7))}


def brute(docs):
    docs = sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0, str(d[1])))
    spots = {}
    for d, text in docs:
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(STRIP):
                spots.setdefault(line.strip(STRIP), []).append((d is not None, d or 0, k, text))
    lines = list(spots)
    sets = [grams(x) for x in lines]
    up = list(range(len(lines)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    close, having = 0, {}
    for i, mine in enumerate(sets):
        both = Counter(j for g in mine for j in having.get(g, ()))
        for j, n in both.items():
            if n >= 0.8 * (len(mine) + len(sets[j]) - n):
                up[find(i)] = find(j)
                close += 1
        for g in mine:
            having.setdefault(g, []).append(i)
    classes = {}
    for i, line in enumerate(lines):
        classes.setdefault(find(i), []).extend(spots[line])
    gone = {}
    for places in classes.values():
        for has, d, k, text in sorted(places)[1:]:
            gone.setdefault((d if has else None, text), []).append(k)
    return sorted(((d, sum(bool(x.strip(STRIP)) for x in (t or "").split("\n")),
                    sorted(gone.get((d, t), []))) for d, t in docs), key=str), close


def run(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("lid", F.lit("clash"))
    return sorted(((r.doc_id, r.n_lines, r.removed) for r in L.removals(df).collect()), key=str)


def corpus(rng, n):
    vocab = ["".join(rng.choices("abcdefghijklmno", k=rng.randrange(2, 9))) for _ in range(600)]
    base = [" ".join(rng.choices(vocab, k=rng.randrange(1, 60))) for _ in range(60)]
    docs = []
    for d in range(n):
        lines = []
        for _ in range(rng.randrange(6)):
            kind = rng.random()
            if kind < 0.4:
                lines.append(" ".join(rng.choices(vocab, k=rng.randrange(1, 60))))
            else:
                w = rng.choice(base).split()
                if kind > 0.6:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
                lines.append(" ".join(w))
        docs.append((d, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("block", [500, 2_000_000])
def test_removals_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK_CHARS", block)
    docs = corpus(random.Random(11), 250)
    want, close = brute(docs)
    assert close > 100 and run(spark, docs) == want


def test_edges(spark):
    long = " ".join(f"word{i}" for i in range(30_000))
    docs = [(1, None), (2, ""), (3, "\n \n\t"), (None, "Same line here"), (4, "SAME line here\nx"),
            (5, " same line here \r\n\nsame line here"), (5, " same line here \r\n\nsame line here"),
            (7, "x"), (8, "y\nY"), (9, long), (10, long + " end"), (7, "other text of seven")]
    assert run(spark, docs) == brute(docs)[0]
    assert run(spark, []) == []


def test_recall_of_banding():
    rng = random.Random(2)
    hit = n = 0
    for _ in range(400):
        a = "".join(rng.choices("abcdefgh ", k=300))
        b = list(a)
        for _ in range(rng.randrange(1, 5)):
            b[rng.randrange(300)] = "z"
        b = "".join(b)
        x, y = grams(a), grams(b)
        if len(x & y) >= 0.8 * len(x | y):
            n += 1
            keys = L.band_keys(*L.shingles([a, b]))
            hit += bool((keys[0] == keys[1]).any())
    assert n > 50 and hit >= 0.99 * n


def test_similar_is_exact():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for _ in range(60)]
    up = list(range(60))
    edges = L.similar(sets, 0.6)
    label = np.arange(60)
    for _ in range(60):
        for a, b in edges:
            label[[a, b]] = min(label[a], label[b])
    want = np.arange(60)
    for _ in range(60):
        for i in up:
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if both >= 0.6 * (len(sets[i]) + len(sets[j]) - both):
                    want[[i, j]] = min(want[i], want[j])
    assert (label == want).all()


def test_dedup_lines(spark):
    df = spark.createDataFrame(
        [(1, "first line of text\nown", "s", 5), (2, "first line of text\nother things\n", "s", 5),
         (3, "first line of text", None, None), (4, None, "s", 0), (5, "", "s", 0)],
        "doc_id bigint, text string, source string, n_chars bigint")
    got = L.dedup_lines(df)
    assert got.columns == df.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == [
        (1, "first line of text\nown", "s", 22), (2, "other things\n", "s", 13), (4, None, "s", None), (5, "", "s", 0)]


def test_alike_is_exact():
    rng = random.Random(6)
    lines = ["".join(rng.choices("abc ", k=rng.randrange(1, 40))) for _ in range(60)]
    lines += [x[:rng.randrange(1, len(x) + 1)] + rng.choice(["", "c", "zz"]) for x in lines]
    h, begin = L.shingles(lines)
    left, right = (np.array(x) for x in zip(*[(i, j) for i in range(120) for j in range(120) if i != j]))
    got = L.alike(h, begin, left, right, 0.8)
    sets = [grams(x) for x in lines]
    want = [len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i, j in zip(left, right)]
    assert got.tolist() == want and sum(want) > 20


@pytest.mark.parametrize("seed", range(6))
def test_buckets_of_sorted_rows_at_any_batch_size(seed):
    """Streaming gives the least id and every other id of each shared key."""
    import pyarrow as pa
    rng = np.random.default_rng(seed)
    key, ids = rng.integers(0, 12, 90), rng.integers(0, 5 if seed % 2 else 400, 90)
    order = np.lexsort((ids, key))
    key, ids = key[order], ids[order]
    want = set()
    for k in set(key.tolist()):
        mine = set(ids[key == k].tolist())
        if len(mine) > 1:
            want |= {(min(mine), i) for i in mine}
    for size in (1, 2, 7, 90):
        batches = [pa.RecordBatch.from_arrays([pa.array(key[lo:lo + size]), pa.array(ids[lo:lo + size])], names=["key", "id"])
                   for lo in range(0, 90, size)]
        got = {(a, b) for out in L._buckets(iter(batches))
               for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True)}
        assert got == want


def test_forgotten_line_ids_only_repeat_work(spark, monkeypatch):
    docs = [(k, f"a fairly common line of some length\nline number {k % 7} of a document") for k in range(40)]
    whole = run(spark, docs)
    monkeypatch.setattr(L, "SEEN", 1)
    assert run(spark, docs) == whole


def test_bit_table_comes_to_the_driver_in_words(spark, monkeypatch):
    """A row of 64 bits, not a row a bit: the driver holds size / 64 rows at most."""
    from pyspark.sql.classic.dataframe import DataFrame

    from ratewise.llm.buckets import bit_table
    got, collect = [], DataFrame.collect

    def counted(self):
        out = collect(self)
        got.append(len(out))
        return out

    monkeypatch.setattr(DataFrame, "toPandas", lambda self: pytest.fail("a row a bit"))
    monkeypatch.setattr(DataFrame, "collect", counted)
    ids = [0, 1, 63, 64, -1, -64, 1 << 40, (1 << 63) - 1, -(1 << 63), 4095, 1000]
    table = bit_table(spark.createDataFrame([(x,) for x in ids * 2], "id bigint"), "id", 1 << 12)
    want = np.zeros(1 << 12, bool)
    want[[x & 4095 for x in ids]] = True
    assert np.array_equal(np.unpackbits(table).view(bool), want)
    full = bit_table(spark.range(1 << 13), "id", 1 << 12)
    assert np.unpackbits(full).all() and max(got) <= (1 << 12) // 64
    assert not bit_table(spark.range(0), "id", 1 << 12).any()
    docs = [(k, f"a fairly common line of some length\nline number {k % 7} of a document") for k in range(40)]
    L.line_links(spark.createDataFrame(docs, "doc_id bigint, text string"))
