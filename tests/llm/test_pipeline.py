import hashlib
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline as P
import test_fuzzy_lines
import test_simhash
import test_winnow
from ratewise.llm import fuzzy_lines, language, line_rules, sentencepiece_bpe, simhash, winnow
from ratewise.llm.common import row_key

SF = "/root/testdata/sf0.001"


def brute(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.load(language.fit(table))
    docs = [(r.doc_id, r.text) for r in table.collect()]
    docs = [d for d in docs if model.predict(d[1])[1] >= language.MIN_SCORE]
    gone = {d: (n, removed) for d, n, removed in test_fuzzy_lines.brute(docs)[0]}
    docs = [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d][1]))
            for d, t in docs if not gone[d][1] or len(gone[d][1]) < gone[d][0]]
    docs = [(d, t) for (d, t) in docs if d in {c for _, _, c in test_simhash.brute(docs)}]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in test_winnow.brute(docs, items) if r[-1]}
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.model_path())
    out = []
    for d, t in docs:
        if d not in bad:
            ids = [1, *lib.encode(t), 2]
            out.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                        hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    return sorted(out)


def test_run_matches_brute_force(spark):
    got = sorted(tuple(r) for r in P.run(spark, SF).collect())
    assert got == brute(spark) and 50 < len(got) < 200


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for rows in (docs.limit(20), docs.limit(0)):
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, rows, SF)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            out.collect()


CLASH = ["_key", "_KEY", "_text", "_keys", "_doc", "_hash", "_removed", "n_lines", "n_removed", "removed", "text_hash", "key", "root",
         "line_hash", "Removed_Lines", "row_key", "text_key", "document_key", "line_keys", "id", "fp", "component_id", "first"]


@pytest.mark.parametrize("name", ["dedup_lines", "keep_one", "winnow", "line_rules", "language"])
def test_extra_columns_of_any_name_stay_as_they_are(spark, name):
    stage = dict(dedup_lines=fuzzy_lines.dedup_lines, keep_one=simhash.keep_one, line_rules=line_rules.clean,
                 winnow=lambda d: winnow.clean(d, spark.read.parquet(f"{SF}/benchmark.parquet")),
                 language=lambda d: language.keep(d, language.fit(d)))[name]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.limit(40) if name == "line_rules" else docs
    plain = sorted((r.doc_id, r.text) for r in stage(docs).collect())
    names = list({c.lower(): c for c in CLASH}.values())
    more = docs.select("*", *[F.lit(c).alias(c) for c in names])
    out = stage(more)
    assert out.columns == more.columns
    got = out.collect()
    assert sorted((r.doc_id, r.text) for r in got) == plain and 0 < len(got)
    assert all(r[c] == c for r in got for c in names)


def test_null_and_text_ids_are_told_apart(spark):
    """64 bits of hash alone give NULL, 'a' and 'a', NULL the same value."""
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", ""), ("", "a")], "doc_id string, text string")
    assert df.select(row_key("doc_id", "text").alias("k")).distinct().count() == 4
