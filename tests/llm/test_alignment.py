import hashlib
from collections import Counter

import numpy as np
import pytest

from ratewise.llm import alignment as A

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coders():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def spelled(text, coders):
    """(ids and bytes) of both sides by the libraries the files belong to."""
    a, b = coders
    alphabet = A.byte_alphabet()
    ea = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in ea.ids]
    right = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    return left, right


def brute(texts, coders):
    """Two pointers over one document at a time; counts by Counter."""
    made, held = [], Counter()
    for text in texts:
        left, right = spelled(text, coders) if text else ([], [])
        said = b" " + (text or "").encode()
        if not text or b"".join(x for _, x in left) != said or b"".join(x for _, x in right) != said:
            made.append((0, 0, 0, [], ""))
            continue
        spans = []
        for side in (left, right):
            at, here = 0, []
            for i, x in side:
                here.append((at, at + len(x), i))
                at += len(x)
            spans.append(here)
        links = [(i, j) for s, e, i in spans[0] for t, f, j in spans[1] if s < f and t < e] if len(said) < 3000 \
            else two_pointers(*spans)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, lo = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if lo <= s and e <= c) for side in spans)
                          if len(said) < 3000 else None)
            lo = c
        if len(said) >= 3000:
            groups = fast_groups(spans, cuts)
        made.append((len(left), len(right), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        held.update(set(links))
    best = Counter()
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    return [(a, b, g, len(x), sum(held[p] == best[p[0]] for p in x), sum(held[p] for p in x), h)
            for a, b, g, x, h in made]


def two_pointers(left, right):
    i = j = 0
    out = []
    while i < len(left):
        out.append((left[i][2], right[j][2]))
        a, b = left[i][1], right[j][1]
        i, j = i + (a <= b), j + (b <= a)
    return out


def fast_groups(spans, cuts):
    out, at = [], [0, 0]
    for c in cuts:
        sides = []
        for k, side in enumerate(spans):
            ids = []
            while at[k] < len(side) and side[at[k]][1] <= c:
                ids.append(str(side[at[k]][2]))
                at[k] += 1
            sides.append(",".join(ids))
        out.append("|".join(sides))
    return out


def got(df, **kw):
    return [tuple(r)[1:7] + (r.groups_sha256,) for r in sorted(A.align(df, **kw).collect(), key=lambda r: r.doc_id)]


TEXTS = ["Hello world", "", None, "a<|endoftext|>b </s> <0x41>", "café 日本語 \U0001f469‍\U0001f467 x", "▁mark", "tab\tnew\n\nline  two   spaces ",
         "Hello world", " lead", "0123456789" * 30, "é" * 50, "a" * 400, "word " * 3000, "\0\x01", "�?", " ", "\n"]


def test_edges_match_brute_force(spark, coders):
    df = spark.createDataFrame([(i, t, "clash", 0) for i, t in enumerate(TEXTS)],
                               "doc_id bigint, text string, pairs string, row int")
    assert got(df) == brute(TEXTS, coders)


@pytest.mark.parametrize("frequent", [A.FREQUENT, 50, 0])
def test_documents_match_brute_force(spark, coders, frequent, monkeypatch):
    monkeypatch.setattr(A, "GATHER", 500)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r.text for r in sorted(docs.collect(), key=lambda r: r.doc_id)]
    assert got(docs, frequent=frequent) == brute(texts, coders)


def test_batches_and_lanes_do_not_matter(coders):
    a, b = A.sides((A.file_path(A.BYTE_FILE), A.file_path(A.PIECE_FILE)))
    whole = A._align_texts(TEXTS, a, b)
    for k, text in enumerate(TEXTS):
        alone = A._align_texts([text], a, b)
        for c in whole:
            assert np.asarray(alone[c])[0] == np.asarray(whole[c])[k], (c, text)
    ends = [np.cumsum(s.size[s.encode(["word café 日本 " * 300])[0]]) for s in (a, b)]
    plain = A.lockstep(*ends, lane=1 << 30)
    for lane in (1, 7, 256):
        split = A.lockstep(*ends, lane=lane)
        assert sorted(zip(*[x.tolist() for x in split[:2]], strict=True)) == list(zip(*[x.tolist() for x in plain[:2]], strict=True))
        assert np.array_equal(np.sort(split[2]), plain[2]) and np.array_equal(np.sort(split[3]), plain[3])


def test_null_ids_repeated_rows_and_empty_table(spark, coders):
    texts = ["one two", "one two", "one two", "three"]
    df = spark.createDataFrame([(None, texts[0]), (1, texts[1]), (1, texts[2]), (2, texts[3])], "doc_id bigint, text string")
    rows = sorted(tuple(r)[1:7] + (r.groups_sha256,) for r in A.align(df).collect())
    assert rows == sorted(brute(texts, coders))
    assert A.align(df.limit(0)).collect() == []
    assert all(r.count_sum == 0 and r.groups_sha256 == "" for r in A.align(df.select("doc_id", df.text.substr(1, 0).alias("text"))).collect())
