import re
from itertools import permutations

import numpy as np
import pytest

from ratewise.llm import filter_audit as A

SF = "/root/testdata/sf0.001"


def brute(docs, labels):
    """Every order applied step by step to the documents themselves."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = []
    for k, (i, text, _) in enumerate(docs):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        f = set()
        if len(words) < 50:
            f.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            f.add("C")
        if re.search("[#$%&*|]", text):
            f.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs):
            f.add("E")
        fails.append(f)
    out = {}
    for part in {s or "" for _, _, s in docs}:
        mine = [k for k, d in enumerate(docs) if (d[2] or "") == part]
        share = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                left = [k for k in left if f not in fails[k]]
                failing = [k for k in mine if f in fails[k]]
                share[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(fails[k] == {f} for k in mine),
                    sum(docs[k][0] in good for k in gone), sum(docs[k][0] in toxic for k in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(share[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def got(spark, docs, labels):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, source string, part string, mask int")
    lab = spark.createDataFrame([(*x, "y") for x in labels], "doc_id bigint, quality int, toxic int, good string")
    rows = A.audit(A.weighted(A.masks(df), lab)).collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): tuple(r[f] for f in A.FIELDS) for r in rows}


def test_documents_match_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert got(spark, docs, labels) == brute(docs, labels)


def test_edges_match_brute_force(spark):
    long = " ".join(f"w{k}" for k in range(60))
    docs = [(1, None, "a"), (2, "", None), (3, "", "a"), (3, "", "a"), (None, "", "a"), (None, None, None),
            (4, long, "b"), (5, long, "b"), (5, long, "b"), (0, long, ""), (6, "A B " * 400, "b"),
            (7, "é" * 10 + "A", "b"), (8, "x\x0by\x1cz w " * 20, "c"), (9, "a|" * 3, "c"), (10, long + " #", "c"),
            (11, "word " * 200_000, "c")]
    labels = [(4, 1, 0), (5, 1, None), (5, 0, 1), (None, 1, 1), (2, None, 1), (99, 1, 1), (6, 1, 1)]
    assert got(spark, docs, labels) == brute(docs, labels)


def test_masks_of_long_texts(monkeypatch):
    text = ("Aa bb\x0bbb é # " * 50).encode()
    whole = A.text_mask(text)
    monkeypatch.setattr(A, "LONG_TEXT", 10)
    assert A.text_mask(text) == whole


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert A.audit(A.weighted(A.masks(docs), labels)).collect() == []
    some = spark.createDataFrame([(1, "a", "s")], docs.schema)
    rows = A.audit(A.weighted(A.masks(some), labels)).collect()
    assert len(rows) == 600 and sum(r.removed for r in rows) == 120


@pytest.mark.parametrize("n", [1, 3, 5])
def test_ranks_are_first_failing_positions(n):
    orders = np.array(list(permutations(range(n))))
    position = np.argsort(orders, 1).T + 1
    got = A.ranks(np.arange(1 << n), position)
    for m in range(1 << n):
        for o, order in enumerate(orders.tolist()):
            assert got[m, o] == next((s for s, f in enumerate(order, 1) if m >> f & 1), n + 1)


def test_hot_copies_spread(spark):
    """A third of all rows are copies of one text under many sources."""
    docs = [(k, "same text", f"s{k % 7}") if k % 3 == 0 else (k, f"text {k}", "other") for k in range(600)]
    assert got(spark, docs, []) == brute(docs, [])


