"""Token counts: an exact histogram of encoded lengths.

Every text is encoded whole with a byte-level BPE vocabulary and only its
number of tokens is kept.  Documents are aggregated by length; sums from the
longest length down then answer, for a context limit L equal to each length
that occurs: how many documents are at least that long, how many tokens all
documents have when cut at L, how many are lost, and the share of documents
that fit whole.  ``limits`` answers any other L, ``quantiles`` any share.

Suffix sums run in two levels, over chunks of ``CHUNK`` lengths and inside
each, so no task holds the whole histogram.

Results: NULL and empty texts have length 0 and are counted.  Strings that look
like special tokens are ordinary text.  An empty table has an empty histogram.
"""

from __future__ import annotations

import base64
from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import by_document, store, table

RANKS = "byte_bpe_50k.tiktoken"
CHUNK = 1024


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def encoding(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def length(text: str | None, enc) -> int:
    """Number of tokens of the whole text."""
    return len(enc.encode_ordinary(text)) if text else 0


def token_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens."""
    return by_document(docs.select("doc_id", "text"), lambda text, enc: (length(text, enc),),
                       "n_tokens bigint", lambda: encoding(path or ranks_path()))


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs): how many documents have each length."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """One row per length that occurs, taken as a context limit: n_docs of that
    length, docs_at_least, tokens_at_least (of those documents), tokens_total
    (of all), truncated_tokens (of all, each cut at the limit), lost_tokens, and
    fits, the share of documents no longer than the limit."""
    rows = hist.withColumn("chunk", F.floor(F.col("n_tokens") / CHUNK)) \
        .withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    chunks = rows.groupBy("chunk").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    chunks = chunks.select(
        "chunk", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(every).alias("docs_total"), F.sum("t").over(every).alias("tokens_total"))
    inside = Window.partitionBy("chunk").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(chunks, "chunk") \
        .withColumn("docs_at_least", F.sum("n_docs").over(inside) + F.col("d_after")) \
        .withColumn("tokens_at_least", F.sum("tokens").over(inside) + F.col("t_after")) \
        .withColumn("lost_tokens", F.col("tokens_at_least") - F.col("docs_at_least") * F.col("n_tokens"))
    return out.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "tokens_total",
        (F.col("tokens_total") - F.col("lost_tokens")).alias("truncated_tokens"), "lost_tokens",
        ((F.col("docs_total") - F.col("docs_at_least") + F.col("n_docs")) / F.col("docs_total")).alias("fits"))


def limits(hist: DataFrame, sizes: list[int]) -> DataFrame:
    """(context, docs_over, truncated_tokens) for each given context limit."""
    return hist.select(F.explode(F.array(*[F.lit(s) for s in sizes])).alias("context"), "n_tokens", "n_docs") \
        .groupBy("context").agg(
            F.sum(F.expr("if(n_tokens > context, n_docs, 0)")).alias("docs_over"),
            F.sum(F.expr("least(n_tokens, context) * n_docs")).alias("truncated_tokens"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length that at least that share of the
    documents does not exceed."""
    return sums.select(F.explode(F.array(*[F.lit(s) for s in shares])).alias("share"), "n_tokens", "fits") \
        .where("fits >= share").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    lengths = token_lengths(table(spark, sf_dir, "documents"))
    return suffix_sums(store(histogram(lengths), "histogram"))    # read twice, encoded once
