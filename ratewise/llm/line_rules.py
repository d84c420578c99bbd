"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules count, in each whole text, words, symbols, repeated lines and the
words inside repeated windows of ``WINDOW`` words.  A window is known by a
64-bit hash of its words' hashes; only texts in which two hashes are equal sort
them, and all of it stays inside the row.

Method: lines are normalised (stripped, lower-cased, runs of white space one
space) and hashed together with their host (``source``).  For every host and line
the distinct documents are counted; lines of more than ``MAX_DOCS`` documents of
a host are removed.  A document is rejected if it fails a base rule, or if under
``MIN_WORDS`` words or under ``MIN_SHARE`` of its words are left.

Results: NULL and empty texts have no words and fail the base rule.  A NULL
source is a host of its own.  A document is a distinct (doc_id, text), NULL ids
included: repeated rows count as one document and are repeated in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import spare, store, table

WINDOW = 8
MIN_WORDS, REPEAT_PERCENT = 20, 30
MAX_DOCS, MIN_SHARE = 30, 0.5
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\f\r"


def _document() -> Column:
    return F.xxhash64("doc_id", "text")


def _lines() -> Column:
    """Lines of the text that have a word."""
    return F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")


def _line_key(source: str, line: Column) -> Column:
    return F.xxhash64(source, F.lower(F.regexp_replace(F.btrim(line, F.lit(SPACE)), r"[\x20\x09-\x0D]+", " ")))


def _repeat_words(df: DataFrame) -> DataFrame:
    """``df(_words, n_words, ...)`` with n_repeat_words: the words covered by
    windows that occur twice or more."""
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    df = df.withColumn("_windows", F.when(
        F.col("n_words") >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size("_hashes") - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW)))))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    after = F.slice("_sorted", F.lit(2), F.size("_sorted"))
    pairs = F.zip_with("_sorted", after, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    df = df.withColumn("_at", F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))))
    nexts = F.slice("_at", F.lit(2), F.size("_at"))
    steps = F.zip_with("_at", nexts, lambda a, b: F.coalesce(F.least(F.lit(WINDOW), b - a), F.lit(WINDOW)))
    return df.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, s: total + s), F.lit(0).cast("bigint"))) \
        .drop("_hashes", "_windows", "_sorted", "_at")


def base_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, document key, counts, base_failed."""
    text = F.coalesce("text", F.lit(""))
    df = docs.select("doc_id", "text", _document().alias("_doc"),
                     F.regexp_extract_all(text, F.lit(f"({WORD})"), 1).alias("_words"))
    df = df.withColumn("n_words", F.size("_words").cast("bigint"))
    df = _repeat_words(df)
    lines = F.coalesce(_lines(), F.array().cast("array<string>"))
    df = df.withColumn("_lines", lines)
    return df.select(
        "doc_id", "_doc", "n_words",
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.size(F.regexp_extract_all(text, F.lit("([#*$%&|<>])"), 1)).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"))


def host_lines(docs: DataFrame) -> DataFrame:
    """(_doc, no, _key, n): each line's document, number, host-and-line hash and
    words."""
    line = F.posexplode(_lines()).alias("no", "line")
    return docs.select(_document().alias("_doc"), "source", line).select(
        "_doc", "no", _line_key("source", F.col("line")).alias("_key"),
        F.size(F.regexp_extract_all("line", F.lit(f"({WORD})"), 1)).alias("n"))


def frequent_lines(lines: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(_key) of the lines above the limit."""
    return lines.groupBy("_key").agg(F.count_distinct("_doc").alias("docs")).where(F.col("docs") > max_docs) \
        .select("_key")


def _removed(docs: DataFrame, max_docs: int) -> DataFrame:
    """(_doc, removed words, keys of removed lines) of documents that have some.
    A repeated row repeats its lines, so lines are numbered and made distinct."""
    lines = store(host_lines(docs), "host-lines")
    gone = lines.join(frequent_lines(lines, max_docs), "_key", "left_semi").distinct()
    return gone.groupBy("_doc").agg(F.sum("n").alias("_removed"), F.collect_set("_key").alias("_keys"))


def _judge(base: DataFrame, removed: DataFrame) -> DataFrame:
    left = F.col("n_words") - F.col("n_removed_words")
    return (base.join(removed, "_doc", "left")
            .withColumn("n_removed_words", F.coalesce("_removed", F.lit(0)).cast("bigint"))
            .withColumn("kept", ~F.col("base_failed") & (left >= MIN_WORDS) & (left >= MIN_SHARE * F.col("n_words"))))


def verdicts(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, kept,
    and n_removed_words, those of its lines above the limit."""
    return _judge(base_rules(docs), _removed(docs, max_docs).drop("_keys")).drop("_doc", "_removed")


def clean(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """The kept rows of ``docs``, with the lines above the limit cut out of
    ``text``."""
    doc, keys = spare(docs, "document_key", "line_keys")
    removed = _removed(docs, max_docs)
    judged = _judge(base_rules(docs), removed.drop("_keys")).where("kept").select(F.col("_doc").alias(doc)).distinct()
    rows = docs.withColumn(doc, _document()).join(judged, doc, "left_semi").join(
        removed.select(F.col("_doc").alias(doc), F.col("_keys").alias(keys)), doc, "left")
    lines = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(keys, _line_key("source", x)))
    return rows.withColumn("text", F.when(F.col(keys).isNull(), F.col("text"))
                           .otherwise(F.array_join(lines, "\n"))).select(*docs.columns)


def op7_line_rules(spark, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"))


SQL = rf"""
with d as (select doc_id, text, source, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
 lines as (select doc_id, source, unnest(range(1, len(string_split(text, chr(10))) + 1)) as no,
   unnest(string_split(text, chr(10))) as line from d),
 full_lines as (select *, lower(regexp_replace(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
   '[\x20\x09-\x0D]+', ' ', 'g')) as norm, len(regexp_extract_all(line, '{WORD}')) as n
   from lines where regexp_matches(line, '{WORD}')),
 dups as (select doc_id, count(*) - count(distinct line) as n_dup_lines from full_lines group by doc_id),
 wins as (select doc_id, unnest(range(1, len(w) - {WINDOW} + 2)) as pos,
   unnest(list_transform(range(1, len(w) - {WINDOW} + 2), lambda i: array_to_string(w[i:i + {WINDOW} - 1], ' '))) as win
   from d where len(w) >= {WINDOW}),
 twice as (select doc_id, win from wins group by doc_id, win having count(*) > 1),
 covered as (select doc_id, count(distinct p) as n_repeat_words from (
   select doc_id, unnest(range(pos, pos + {WINDOW})) as p from wins join twice using (doc_id, win)) group by doc_id),
 frequent as (select source, norm from full_lines group by source, norm having count(distinct doc_id) > {MAX_DOCS}),
 gone as (select l.doc_id, sum(n) as removed from full_lines l join frequent f
   on l.norm = f.norm and l.source is not distinct from f.source group by l.doc_id),
 base as (select doc_id, cast(len(w) as bigint) as n_words,
   cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
   cast(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) as bigint) as n_symbols,
   cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
   cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
   cast(coalesce(removed, 0) as bigint) as n_removed_words
   from d left join dups using (doc_id) left join covered using (doc_id) left join gone using (doc_id)),
 judged as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words as base_failed
   from base)
select *, not base_failed and n_words - n_removed_words >= {MIN_WORDS}
 and n_words - n_removed_words >= {MIN_SHARE} * n_words as kept from judged
"""
