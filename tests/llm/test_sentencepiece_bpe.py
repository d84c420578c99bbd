import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import sentencepiece_bpe as S

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  a  b ", " leading", "▁x ▁", "日本語テキスト 😀 \0 x", "a\n\nb\t c", "<s> </s> <0x41>", "ΩΩ ﬁ ａ", "\r\n", "x ",
       "   def f(x):\n        return x  ", "a" * 300, " " * 50 + "x", "é" * 70, "the" * 40, "​  é", "\n" * 9, " \nThe \n\nx\n The\nThe", "\nThe The"]


@pytest.fixture(scope="module")
def lib():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=S.model_path())


@pytest.fixture(scope="module")
def codec():
    return S.Codec(S.model_path())


def test_odd_and_random_texts(codec, lib):
    rng = random.Random(1)
    chars = "aeinrst  .,\n▁éß日😀0<>|\t"
    texts = ODD + ["".join(rng.choices(chars, k=rng.randrange(60))) for _ in range(2000)]
    for text in texts:
        ids = [1, *lib.encode(text), 2]
        assert codec.encode(text) == ids and codec.decode(ids) == lib.decode(ids)


def test_decoding_of_any_ids(codec, lib):
    rng = random.Random(3)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32000)]) for _ in range(rng.randrange(9))]
        assert codec.decode(ids) == lib.decode(ids)


def test_cache_bounds_change_nothing(lib, monkeypatch):
    monkeypatch.setattr(S, "CACHE_WORDS", 3)
    monkeypatch.setattr(S, "CACHE_CHARS", 4)
    monkeypatch.setattr(S, "CACHE_PAIRS", 5)
    small = S.Codec(S.model_path())
    text = "some words come back, some words\ndo not \ncome back " * 5
    assert small.encode(text) == [1, *lib.encode(text), 2]


def test_documents_and_edges(spark, lib):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(None, "null id"), (-1, None), (-2, ""), (-3, "w " * 300_000), (-4, "x" * 100_000),
                                   (-5, "same"), (-5, "same")], docs.schema)
    rows = docs.unionAll(extra).withColumn("n_tokens", F.lit("clash"))
    want = []
    for r in rows.collect():
        ids = [1, *lib.encode(r.text or ""), 2]
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    got = S.digests(rows)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert S.digests(rows.limit(0)).collect() == []
    one = S.encode(docs.limit(3)).collect()
    assert all(r.ids[0] == 1 and r.ids[-1] == 2 for r in one)
