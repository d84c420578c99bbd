"""Corpus pipeline: each stage's rows are written and read by the next one.

Documents whose language is not recognised go, then lines that repeat or nearly
repeat, then near-copies of documents, then documents with benchmark passages;
what is left is encoded.  NULLs, empty texts and repeated rows are handled as the
operators' docstrings say; an empty table gives an empty result.
"""

from __future__ import annotations

from ratewise.llm import fuzzy_lines, language, sentencepiece_bpe, simhash, winnow
from ratewise.llm.common import BATCH_CONF, scratch, table


def _lean(spark):
    """Stages follow each other on the same executors: smaller Arrow batches and
    Parquet row groups keep the texts in flight small."""
    spark.conf.set(BATCH_CONF, str(4 << 20))
    spark.conf.set("parquet.block.size", str(16 << 20))


def language_id(spark, docs, sf_dir):
    _lean(spark)
    return language.keep(docs, language.fit(docs))


def line_dedup(spark, docs, sf_dir):
    _lean(spark)
    return fuzzy_lines.dedup_lines(docs)


def simhash_dedup(spark, docs, sf_dir):
    _lean(spark)
    return simhash.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    _lean(spark)
    return winnow.clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark, docs, sf_dir):
    _lean(spark)
    return sentencepiece_bpe.digests(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: A trained model, hashed shingles and a tokenizer cannot be expressed in SQL;
#: tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
