import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from ratewise.llm import winnow

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        m = min(len(w), 13)
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k:k + m]), set()).add(i)
    out = []
    for d, text in docs:
        w, hit, ids = words(text), set(), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if (found := windows.get(tuple(w[k:k + m]))) is not None:
                    hit.update(range(k, k + m))
                    ids |= found
        ids = sorted(str(x) for x in ids if x is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("n_hit", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id bigint, text string").withColumn("hits", F.lit(1))
    return sorted((tuple(r) for r in winnow.contamination(d, b).collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(40)] + ["É", "ü1", "A", "b"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 5, 12, 13, 14, 30, 60])))) for i in range(40)]
    items += [(7, items[20][1]), (100, None), (101, ""), (102, " .,;"), (None, " ".join(rng.choices(vocab, k=20)))]
    docs = []
    for d in range(120):
        w = rng.choices(vocab, k=rng.randrange(0, 400))
        for _ in range(rng.randrange(3)):
            src = words(rng.choice(items)[1])
            if src:
                a = rng.randrange(len(src))
                at = rng.randrange(len(w) + 1)
                w[at:at] = src[a:a + rng.choice([5, 12, 13, 20, 60])]
        docs.append((d, rng.choice([" ", "\n", ", "]).join(w).upper() if d % 3 else " ".join(w)))
    docs += [(3, docs[3][1]), (900, None), (901, ""), (None, items[30][1]), (902, "x" * 100_000),
             (903, "long " * 50_000 + (items[35][1] or ""))]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == brute([(1, "a b")], [])


def test_every_shared_run_selects_a_shared_fingerprint():
    rng = np.random.default_rng(3)
    for _ in range(200):
        span = rng.integers(0, 6, winnow.SIZE).astype(np.uint64)
        sides = [np.concatenate([rng.integers(0, 6, 20), span, rng.integers(0, 6, 20)]).astype(np.uint64)
                 for _ in range(2)]
        a, b = ({int(x) for p, x in zip(*winnow.fingerprints(s, np.zeros(len(s), int))) if 20 <= p <= 28}
                for s in sides)
        assert a & b


def test_hash_depends_on_the_word_alone(monkeypatch):
    monkeypatch.setattr(winnow, "CHUNK", 50)
    data = ("Abc, déf " * 40 + "z" * 200 + " abc").encode()
    low, s, e, h = winnow.words_of(data)
    by = {}
    for i in range(len(s)):
        by.setdefault(low[s[i]:e[i]].tobytes(), set()).add(int(h[i]))
    assert len(by) == 3 and all(len(x) == 1 for x in by.values())


def test_clean_keeps_columns(spark):
    d = spark.createDataFrame([(1, "one two three", "s"), (2, "other", None), (None, "x y", "t"), (None, "a two three", "t")],
                              "doc_id bigint, text string, source string")
    b = spark.createDataFrame([(1, "two three")], "item_id bigint, text string")
    got = winnow.clean(d, b)
    assert got.columns == d.columns and sorted(r.text for r in got.collect()) == ["other", "x y"]
