import hashlib
import random
import re

from pyspark.sql import functions as F

from ratewise.llm import pii as P

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - (9 if d > 4 else 0)
    return total % 10 == 0


def ok(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
            "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 10 <= len(digits) <= 15}[kind]()


def base(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text or "") if ok(kind, m[0])]
    return sorted(found)


def brute(d, text):
    found = base(text)
    joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in found)
    return (d, *[sum(f[3] == k for f in found) for k in PATTERNS], hashlib.sha256(joined.encode()).hexdigest())


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("spans", F.lit("clash"))
    return P.report(df).collect()


def check(got, rows):
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((brute(*r) for r in rows), key=str)
    by = {d: t for d, t in rows}
    for r in got:
        have = set(filter(None, r.spans.split(",")))
        assert {f"{k}:{s}:{e}" for s, _, e, k in base(by[r.doc_id])} <= have


def test_documents_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = run(spark, rows)
    check(got, rows)
    tokens = {(d, m.start(1), m.end(1)) for d, t in rows for m in re.finditer(r'token = "([0-9a-f]{40})"', t)}
    keys = {(r.doc_id, *map(int, s.split(":")[1:])) for r in got for s in r.spans.split(",") if s.startswith("key:")}
    assert tokens and tokens <= keys


def test_random_texts_match_brute_force(spark):
    rng = random.Random(9)
    bits = ["a", "b.c", "@", ".", "-", "_", "+", "%", " ", "\n", "1", "23", "256", "4111111111111111", "é", "x@y.z", "(",
            ")", "\x01", "\x02", "😀", "+1 (555) 123-4567", "1.2.3.4", "4111 1111 1111 1111", "00012", "$1", "\\"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randrange(1, 40)))) for i in range(600)]
    check(run(spark, rows), rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "mail me a.b@c.org"), (4, "x@y.zz " * 3), (4, "x@y.zz " * 3),
            (5, "7" * 60_000), (6, "a" * 60_000), (7, "a." * 30_000 + "@"), (8, "1-" * 30_000), (9, "+" + "1(" * 30_000),
            (10, "1." * 30_000), (11, "a@b" * 20_000), (12, "q@w.e," * 5_000), (13, "a@" + "b." * 30_000),
            (14, "(" * 40_000 + "1" * 40_000)]
    check(run(spark, rows), rows)
    assert run(spark, []) == []


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"some text . contact phone: +1 555 {100 + i} 200{i % 10} thanks w{i}") for i in range(12)]
    rows += [(50, "other text . contact phone: 555-0199-77 thanks all"), (51, "version 12.0-3455 of the 555-0199-78 code")]
    got = {r.doc_id: r.spans for r in run(spark, rows)}
    at = rows[12][1].index("555")
    assert got[50] == f"phone:{at}:{at + 11}" and got[51] == ""


def contexts(spark, text):
    rows = P.find(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    return {(r.kind, r.value): (r.two_left, r.around) for r in rows}


def test_contexts_are_the_text_around_whatever_stands_there(spark):
    got = contexts(spark, "room 12 phone: +1 555 100 2001 3 thanks")
    assert got["phone", "+1 555 100 2001 3"] == ("0 phone:", "phone: _ thanks")
    got = contexts(spark, "room 12 phone: 555-0199-77 3 thanks")
    assert got["candidate", "555-0199-77"] == ("0 phone:", "phone: _ 0")
    got = contexts(spark, 'a1 b2 "c3d4", e5 x@y.zz, q@w.ee ' + "1 " * 100 + "z9")
    assert got["candidate", '"c3d4",'] == ("a0 b0", "b0 _ e0")
    assert got["email", "q@w.ee"] == ("e0 x@y.zz,", "x@y.zz, _ 0")
    assert got["candidate", "z9"] == ("0 0", "0 _ $")


def test_candidates_with_numbers_on_either_side_are_found(spark):
    rows = [(i, f"room {i} phone: +1 555 {100 + i} 200{i % 10} thanks w{i}") for i in range(12)]
    rows += [(50, "room 12 phone: 555-0199-77 thanks all"), (51, "see 12 phone: 555-0199-78, 34 of 99")]
    got = {r.doc_id: r.spans for r in run(spark, rows)}
    for d, text in rows[12:]:
        assert got[d] == f"phone:{text.index('555')}:{text.index('555') + 11}"


def test_runs_of_digit_tokens_are_found_whole(spark):
    rows = [(i, f"some text . contact phone: +1 555 {100 + i} 200{i % 10} thanks w{i}") for i in range(40)]
    found = {50: "030 1234 567", 51: "(555) 010-9977", 52: "030 (12) 34 - 56", 53: "555-0199-77"}
    rows += [(d, f"other text . contact phone: {v} thanks all") for d, v in found.items()]
    rows += [(60, "version 030 1234 568 of it"), (61, "contact phone: 1 2 thanks"),
             (62, "contact phone: 030 1234 569 +1 555 300 4000 thanks")]
    got = {r.doc_id: r.spans for r in run(spark, rows)}
    for d, v in found.items():
        at = dict(rows)[d].index(v)
        assert got[d] == f"phone:{at}:{at + len(v)}"
    assert got[60] == got[61] == "" and got[62] == "phone:15:27,phone:28:43"


def test_unseen_values_are_no_proof_against_a_kind(spark):
    def edges(pattern, seeds, unseen, kind="phone"):
        return [(pattern, v, kind) for v in seeds] + [(pattern, v, None) for v in unseen]

    phones = [f"+1 555 100 {i:04}" for i in range(600)]
    local = [f"555-{i:04}" for i in range(300)]
    rows = edges("L phone:", phones, local) + edges("L call", phones[:3], local[:1])
    rows += edges("L on", phones[:3], [f"2019-01-{i:04}" for i in range(60)])
    rows += edges("L by", phones[:9], [f"mr-x{i}" for i in range(20)])
    rows += edges("L id", phones[:8], []) + edges("L id", ["a@b.cc", "d@e.ff", "g@h.ii", "j@k.ll"], [], "email")
    df = spark.createDataFrame(rows, "pattern string, value string, seed string")
    got = {(r.pattern, r.kind) for r in P.score_patterns(df, 1).collect()}
    assert got == {("L phone:", "phone"), ("L call", "phone")}


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    for part in (P.find(df), P.report(df)):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|ArrowEval", plan)
