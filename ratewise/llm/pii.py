"""Personal data by bootstrapped contextual extraction, in DataFrame functions.

Base: e-mail, ip, card and phone patterns, leftmost and non-overlapping for each
kind, checked afterwards.  Matches are marked by a replacement that puts two
control characters around them (such characters in a text are first replaced one
for one), the marked text is split, and running sums of the pieces' lengths give
the positions.

Method: the base matches, and hexadecimal keys, are seed entities.  Candidates
are the other tokens with a digit or an @, and runs of neighbouring digit tokens
(the shape of phones and cards without their checks); both have at least
``MIN_CHARS`` characters.  A reported run covers its tokens.  Every occurrence
has two lexical patterns: the two words before it, and the words on both sides,
taken from the text around it by position, whatever stands there.  Patterns and
values form a graph that is scored for ``ROUNDS`` rounds: a pattern's confidence
in a kind is its values' summed score over the number of its values (plus
``PRIOR``), where a value without any score counts ``FITS`` if it has the kind's
shape and ``ODD`` if not, as it may be an unseen one.  A value's score is one
minus the product of its patterns' doubts; seeds stay at one.  Patterns count
from ``SUPPORT`` values of the kind and a confidence of ``CONFIDENCE`` on.  A
candidate in such a pattern is reported
as that kind; base matches stay as they are.

Results: positions are code points, end exclusive.  NULL and empty texts have
none.  A document is a distinct (doc_id, text); repeated rows are repeated in the
result and count once in the graph.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import store, table

_LOCAL = "A-Za-z0-9._%+-"
#: Possessive forms of the contract's patterns: what follows a repeat never
#: needs a character back.  Starts inside a run that has failed are skipped.
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KEY = "key"
KINDS = [*BASE, KEY]
#: A text without the character has no match.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
PUNCTUATION = "!\"#$%&'()*,-./:;<=>?@[\\]^_`{|}~"
#: Before a value a label's end is kept.
OPENING = PUNCTUATION.translate({ord(c): None for c in ":="})
MIN_CHARS = 6
#: The shape of phones and cards without their checks, token by token: how
#: a token that goes on ends, how one that follows begins, what is between them.
GOES_ON, FOLLOWS, BETWEEN = r"[0-9][().-]*$", r"^[(.-]*[0-9]", r"^[\x20().-]+$"
ROUNDS, PRIOR, SUPPORT, CONFIDENCE = 3, 0.5, 3, 0.75
CONTEXT_CHARS = 80
#: What a value of no known kind counts against a kind: with the kind's shape, without.
FITS, ODD = 0.1, 0.5
SHAPES = {
    "email": r"^[^@]+@[^@]+$",
    "ip": r"^[0-9a-f]*[.:][0-9a-f.:]*(?:/[0-9]+)?$",
    "card": r"^[0-9][0-9\x20-]{10,}[0-9]$",
    "phone": r"^[+(]*[0-9][().0-9\x20-]*$",
    KEY: r"^[0-9a-z+/=_-]{16,}$",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        digits = F.translate(value, " -", "")
        n = F.length(digits)
        each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
            i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
        luhn = F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0
        return F.when((n >= 14) & (n <= 19), luhn).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def _words(text: Column) -> Column:
    """Lower-cased words of a short text, digits as 0."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), "[0-9]+", "0"), r"\s+"), lambda w: w != "")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(pieces: Column, first: Column, last: Column) -> Column:
    """Some pieces as one text (``slice`` would copy all of them)."""
    return F.array_join(F.transform(F.sequence(first, last), lambda j: F.get(pieces, j)), "")


def _enough(text: Column, otherwise: Column) -> Column:
    return F.when(F.length(text) >= CONTEXT_CHARS, text).otherwise(otherwise)


def _before(tails: Column, i: Column) -> Column:
    """The last ``CONTEXT_CHARS`` characters before match ``i``.  A match has a
    character, and so has the text between two neighbours or else the match a
    second one, so as many pieces hold them."""
    def last(n):
        return F.substring(_pieces(tails, F.greatest(2 * i + 1 - n, F.lit(0)), 2 * i), -CONTEXT_CHARS, CONTEXT_CHARS)

    return _enough(F.get(tails, 2 * i), _let(last(5), lambda t: _enough(t, last(CONTEXT_CHARS))))


def _after(heads: Column, i: Column) -> Column:
    """The first ``CONTEXT_CHARS`` characters after match ``i``."""
    def first(n):
        end = F.least(2 * i + 1 + n, F.size(heads) - 1)
        return F.substring(_pieces(heads, 2 * i + 2, end), 1, CONTEXT_CHARS)

    return _enough(F.get(heads, 2 * i + 2), _let(first(5), lambda t: _enough(t, first(CONTEXT_CHARS))))


def _marked(kind: str, pattern: str) -> Column:
    """``_text`` split into its matches of one kind and what is between them."""
    marked = F.split(F.regexp_replace("_text", f"({pattern})", "\x01$1\x02"), "[\x01\x02]")
    if kind in NEEDS:
        marked = F.when(F.contains("_text", F.lit(NEEDS[kind])), marked).otherwise(F.array(F.lit("")))
    return marked


def _matches(kind: str) -> Column:
    """Matches of one kind as structs: kind, number, gap (length of the text
    before it since the last match), value and the words around it, without
    the punctuation that touches it."""
    marked, tails, heads = F.col(f"_{kind}"), F.col(f"_{kind}_tails"), F.col(f"_{kind}_heads")

    def one(i):
        before, value = F.get(marked, 2 * i), F.get(marked, 2 * i + 1)
        left = _words(F.rtrim(_before(tails, i), F.lit(OPENING)))
        right = _words(F.ltrim(_after(heads, i), F.lit(PUNCTUATION)))
        return _let(F.struct(left.alias("left"), F.get(right, F.lit(0)).alias("right")), lambda c: F.struct(
            F.lit(kind).alias("kind"), i.alias("number"), F.length(before).alias("gap"), value.alias("value"),
            F.array_join(F.slice(c["left"], F.greatest(F.size(c["left"]) - 1, F.lit(1)), 2), " ").alias("two_left"),
            F.concat_ws(" ", F.coalesce(F.try_element_at(c["left"], F.lit(-1)), F.lit("^")), F.lit("_"),
                        F.coalesce(c["right"], F.lit("$"))).alias("around"), before.rlike(BETWEEN).alias("next_to")))

    n = (F.size(marked) - 1) / 2
    return F.when(F.size(marked) > 1, F.transform(F.sequence(F.lit(0), n.cast("int") - 1), one))


def find(docs: DataFrame) -> DataFrame:
    """(_doc, kind, start, end, value, two_left, around, next_to) of all base
    matches that pass their check (and of all candidate tokens, as kind
    ``candidate``; next_to: no other token is between it and the last one)."""
    text = F.coalesce("text", F.lit(""))
    clean = F.when(F.contains(text, F.lit("\x01")) | F.contains(text, F.lit("\x02")),
                   F.translate(text, "\x01\x02", "\x03\x03")).otherwise(text)
    df = docs.select(F.xxhash64("doc_id", "text").alias("_doc"), clean.alias("_text"))
    patterns = {**BASE, "candidate": CANDIDATE}
    df = df.select("_doc", *[_marked(kind, pattern).alias(f"_{kind}") for kind, pattern in patterns.items()])
    df = df.where(reduce(lambda a, b: a | b, [F.size(f"_{kind}") > 1 for kind in patterns]))
    ends = {"tails": -CONTEXT_CHARS, "heads": 1}
    df = df.select("*", *[F.transform(f"_{kind}", lambda piece: F.substring(piece, start, CONTEXT_CHARS))
                          .alias(f"_{kind}_{name}") for kind in patterns for name, start in ends.items()])
    empty = F.array().cast("array<struct<kind:string,number:int,gap:int,value:string,two_left:string,around:string,"
                             "next_to:boolean>>")
    df = df.select("_doc", F.inline(F.concat(*[F.coalesce(m, empty) for m in map(_matches, patterns)]))).distinct()
    before = Window.partitionBy("_doc", "kind").orderBy("number")
    df = df.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(before)) \
        .withColumn("start", F.col("end") - F.length("value"))
    checks = reduce(lambda c, kind: c.when(F.col("kind") == kind, _valid(kind, F.col("value"))),
                    ["card", "ip", "phone"], F.when(F.col("kind") == "email", F.lit(True)))
    return df.where(checks.otherwise(F.lit(True))).select(
        "_doc", "kind", "start", "end", "value", "two_left", "around", "next_to")


def candidates(found: DataFrame) -> DataFrame:
    """Candidate tokens and runs without punctuation around them that overlap no
    base match; hexadecimal keys are kept wherever they stand, as kind ``key``."""
    core = F.btrim("value", F.lit(PUNCTUATION))
    lead = F.length("value") - F.length(F.ltrim("value", F.lit(PUNCTUATION)))
    is_base = F.col("kind") != "candidate"
    order = Window.partitionBy("_doc").orderBy("start", "end")
    upto, on = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    df = found.withColumn("core", F.when(is_base, F.col("value")).otherwise(core)) \
        .withColumn("start", F.when(is_base, F.col("start")).otherwise(F.col("start") + lead)) \
        .withColumn("end", F.when(is_base, F.col("end")).otherwise(F.col("start") + F.length("core"))) \
        .withColumn("last", F.max(F.when(is_base, F.col("end"))).over(upto)) \
        .withColumn("next", F.min(F.when(is_base, F.col("start"))).over(on))
    key = F.col("core").rlike("^[0-9A-Fa-f]{32,}$") & F.col("core").rlike("[A-Fa-f]") & F.col("core").rlike("[0-9]")
    free = (F.coalesce("last", F.col("start")) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    tokens = df.where(~is_base).withColumn("is_key", key).withColumn("free", free)
    single = tokens.where((F.length("core") >= MIN_CHARS) & (F.col("free") | F.col("is_key"))) \
        .select("_doc", F.when(F.col("is_key"), KEY).otherwise("candidate").alias("kind"), "start", "end",
                F.col("core").alias("value"), "two_left", "around")
    return single.unionByName(_runs(tokens, lead))


def _runs(tokens: DataFrame, lead: Column) -> DataFrame:
    """Runs of two and more free digit tokens, as candidates.  A bracket that
    opens before the run and closes in it belongs to it."""
    order = Window.partitionBy("_doc").orderBy("start", "end")
    digits = F.col("free") & F.col("core").rlike(r"^\+?[0-9][().0-9-]*$")
    df = tokens.withColumn("digits", digits)
    goes_on = F.lag(F.col("digits") & F.col("value").rlike(GOES_ON)).over(order)
    joined = F.coalesce(F.col("next_to") & F.col("digits") & F.col("value").rlike(FOLLOWS) & goes_on, F.lit(False))
    df = df.withColumn("joined", joined)
    df = df.withColumn("run", F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(order)) \
        .withColumn("more", F.lead("joined").over(order)).where("joined or more")
    part = F.struct("start", "value", "two_left", "around",
                    F.substr("value", lead, F.lit(1)).alias("lead"))
    df = df.groupBy("_doc", "run").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.max("end").alias("end"))
    head, tail = F.get("parts", F.lit(0)), F.element_at("parts", -1)
    value = F.btrim(F.array_join(F.col("parts.value"), " "), F.lit(PUNCTUATION))
    opened = (head["lead"] == "(") & value.rlike(r"^[^(]*\)")
    return df.select(
        "_doc", F.lit("candidate").alias("kind"), (head["start"] - opened.cast("int")).alias("start"), "end",
        F.when(opened, F.concat(F.lit("("), value)).otherwise(value).alias("value"), head["two_left"].alias("two_left"),
        F.concat_ws(" ", F.substring_index(head["around"], " ", 1), F.lit("_"),
                    F.substring_index(tail["around"], " ", -1)).alias("around")) \
        .where(F.length("value") >= MIN_CHARS)


def graph(occurrences: DataFrame) -> DataFrame:
    """(pattern, value, seed) edges: seed is the kind of a seed entity or NULL."""
    pattern = F.explode(F.array(F.concat(F.lit("L "), F.col("two_left")), F.concat(F.lit("B "), F.col("around"))))
    seed = F.when(F.col("kind") != "candidate", F.col("kind"))
    return occurrences.select(pattern.alias("pattern"), F.lower("value").alias("value"), seed.alias("seed")).distinct()


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that count, after the last
    round; of two kinds the better one."""
    seeds = edges.where("seed is not null").select("value", F.col("seed").alias("kind"),
                                                   F.lit(1.0).alias("score")).distinct()
    links = edges.select("pattern", "value").distinct()
    weight = {kind: F.when(F.col("value").rlike(SHAPES[kind]), FITS).otherwise(ODD) for kind in KINDS}
    sizes = store(links.groupBy("pattern").agg(F.count("*").alias("n"), *[F.sum(weight[k]).alias(f"all_{k}") for k in KINDS])
                  .where(F.col("n") >= SUPPORT), "pii-sizes")
    values, patterns = seeds, None
    for k in range(rounds):
        known = values.groupBy("value").agg(
            *[F.max(F.when(F.col("kind") == kind, F.col("score"))).alias(f"is_{kind}") for kind in KINDS])
        sums = links.join(known, "value").groupBy("pattern").agg(*[F.struct(
            F.sum(F.coalesce(f"is_{kind}", F.lit(0.0))).alias("mass"),
            F.sum(F.when(F.col(f"is_{kind}") >= 0.5, 1).otherwise(0)).alias("support"),
            F.sum(1 - weight[kind]).alias("more")).alias(f"sum_{kind}") for kind in KINDS])
        each = sums.join(sizes, "pattern").select("pattern", F.inline(F.array(*[F.struct(
            F.lit(kind).alias("kind"), F.col(f"sum_{kind}.mass").alias("mass"),
            F.col(f"sum_{kind}.support").alias("support"),
            (F.col(f"all_{kind}") + F.col(f"sum_{kind}.more")).alias("n")) for kind in KINDS])))
        patterns = store(each.withColumn("confidence", F.round(F.col("mass") / (F.col("n") + PRIOR), 9))
                         .where((F.col("support") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE))
                         .select("pattern", "kind", "confidence"), "patterns")
        if k + 1 < rounds:
            doubt = F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.99))))
            found = links.join(patterns, "pattern").groupBy("value", "kind").agg(
                F.round(1 - F.exp(doubt), 9).alias("score"))
            values = found.unionByName(seeds).groupBy("value", "kind").agg(F.max("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("pattern").orderBy(F.desc("confidence"), "kind"))
    return patterns.withColumn("_rank", best).where("_rank = 1").drop("_rank")


def spans(docs: DataFrame) -> DataFrame:
    """(_doc, kind, start, end, base) of every base match and of everything the
    method adds."""
    found = store(find(docs), "pii-matches")
    base = found.where("kind <> 'candidate'").drop("next_to")
    cand = store(candidates(found), "pii-candidates")
    patterns = score_patterns(store(graph(base.unionByName(cand)), "pii-edges"))
    hit = cand.where("kind = 'candidate'").withColumn("pattern", F.explode(F.array(
        F.concat(F.lit("L "), F.col("two_left")), F.concat(F.lit("B "), F.col("around")))))
    added = hit.drop("kind").join(patterns, "pattern").groupBy("_doc", "start", "end").agg(
        F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    earlier = Window.partitionBy("_doc").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    added = added.withColumn("_upto", F.max("end").over(earlier)).where("_upto is null or _upto < end")
    keys = cand.where(F.col("kind") == KEY)
    one = ["_doc", "kind", "start", "end"]
    return base.select(*one, F.lit(True).alias("base")).unionByName(
        added.select(*one).unionByName(keys.select(*one)).withColumn("base", F.lit(False)))


def _joined(rows: Column) -> Column:
    return F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["kind"], r["start"], r["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base
    matches), base_sha256 and spans."""
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    row = F.struct("start", rank.alias("rank"), "end", "kind", "base")
    by_doc = spans(docs).groupBy("_doc").agg(
        F.array_sort(F.collect_list(row)).alias("rows"),
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE])
    base = F.filter("rows", lambda r: r["base"])
    by_doc = by_doc.select("_doc", *[f"n_{k}" for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"),
                           _joined(F.col("rows")).alias("spans"))
    ids = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_doc"))
    return ids.join(by_doc, "_doc", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))


def op9_pii(spark, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
