from pyspark.sql import functions as F

from ratewise.llm import token_counts as T

SF = "/root/testdata/sf0.001"


def reference_lengths(texts):
    """The same vocabulary in another library."""
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def brute(lengths):
    total = sum(lengths)
    out = []
    for limit in sorted(set(lengths)):
        over = [x for x in lengths if x >= limit]
        cut = sum(min(x, limit) for x in lengths)
        out.append((limit, lengths.count(limit), len(over), sum(over), total, cut, total - cut,
                    sum(x <= limit for x in lengths) / len(lengths)))
    return out


def test_documents_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 64)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lengths = reference_lengths([r.text for r in docs.collect()])
    got = T.suffix_sums(T.histogram(T.token_lengths(docs)))
    assert sorted(tuple(r) for r in got.collect()) == brute(lengths)
    hist = T.histogram(T.token_lengths(docs))
    assert sorted(tuple(r) for r in T.limits(hist, [10, 500, 10 ** 6]).collect()) == [
        (c, sum(x > c for x in lengths), sum(min(x, c) for x in lengths)) for c in (10, 500, 10 ** 6)]
    want = [(q, min(x for x in lengths if sum(y <= x for y in lengths) / len(lengths) >= q)) for q in (0.5, 0.9, 1.0)]
    assert sorted(tuple(r) for r in T.quantiles(got, [0.5, 0.9, 1.0]).collect()) == want


def test_edges(spark):
    texts = [None, "", "<|endoftext|>", "a b", "a b", "é ü 日本 \n\n x", "word " * 200_000]
    df = spark.createDataFrame([(i if i else None, t, "clash") for i, t in enumerate(texts)],
                               "doc_id bigint, text string, n_tokens string")
    got = {r.doc_id: r.n_tokens for r in T.token_lengths(df).collect()}
    assert [got[i if i else None] for i in range(len(texts))] == reference_lengths(texts)
    assert T.suffix_sums(T.histogram(T.token_lengths(df.limit(0)))).collect() == []
    total = T.histogram(T.token_lengths(df)).agg(F.sum("n_docs")).first()[0]
    assert total == len(texts)
