import random
import re

from pyspark.sql import functions as F

from ratewise.llm import line_rules as L

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(rows, max_docs):
    docs_of = {}
    for d, text, source in rows:
        for line in (text or "").split("\n"):
            if WORD.search(line):
                docs_of.setdefault((source, " ".join(WORD.findall(line)).lower()), set()).add((d, text))
    out = []
    for d, text, source in rows:
        w = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        places = {}
        for i in range(len(w) - 7):
            places.setdefault(tuple(w[i:i + 8]), []).append(i)
        repeat = len({p for at in places.values() if len(at) > 1 for i in at for p in range(i, i + 8)})
        gone = sum(len(WORD.findall(x)) for x in lines
                   if len(docs_of[source, " ".join(WORD.findall(x)).lower()]) > max_docs)
        failed = len(w) < 20 or 100 * repeat > 30 * len(w)
        left = len(w) - gone
        out.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
                    len(lines) - len(set(lines)), repeat, failed,
                    not failed and left >= 20 and left >= 0.5 * len(w), gone))
    return sorted(out, key=str)


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
         "n_removed_words"]


def run(spark, rows, max_docs):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("kept", F.lit("clash"))
    return sorted((tuple(r) for r in L.verdicts(df, max_docs).select(*NAMES).collect()), key=str)


def corpus():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)] + ["É", "a#b", "<x>", "|"]
    shared = [" ".join(rng.choices(vocab, k=rng.randrange(1, 30))) for _ in range(8)]
    rows = []
    for d in range(150):
        lines = []
        for _ in range(rng.randrange(8)):
            kind = rng.random()
            line = rng.choice(shared) if kind < 0.3 else " ".join(rng.choices(vocab, k=rng.randrange(0, 40)))
            lines += [line.upper() if kind < 0.05 else f" \t{line} "] * (2 if kind > 0.9 else 1)
        rows.append((d, "\n".join(lines), rng.choice(["a", "b", None])))
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    want = brute(rows, 3)
    assert run(spark, rows, 3) == want and any(r[-1] for r in want) and any(r[5] for r in want)


def test_edges(spark):
    rows = [(1, None, "s"), (2, "", None), (3, " \x0b\t\n", "s"), (None, "null id " * 30, "s"),
            (4, "x " * 40, "s"), (4, "x " * 40, "s"), (5, " ".join(f"t{i}" for i in range(100_000)), None),
            (6, "r " * 100_000, "s"), (7, "\n".join(["same line of five words"] * 5000), "s"),
            (8, "a b c d e f g h" + " a b c d e f g h", None), (8, "other text of eight", "s")]
    assert run(spark, rows, 3) == brute(rows, 3)
    assert run(spark, [], 3) == []


def test_repeated_rows_are_one_document(spark):
    text = "one line that comes back\n" + " ".join(f"u{i}" for i in range(40))
    rows = [(1, text, "s")] * 5 + [(2, text.replace("u", "v"), "s")]
    assert run(spark, rows, 2) == brute(rows, 2)


def test_clean(spark):
    body = " ".join(f"word{i}" for i in range(30))
    rows = [(i, f"Boiler plate line\n{body} {i}\nboiler  PLATE line ", "s", i) for i in range(5)] + [(9, body, "t", 9)]
    rows += [(10, "short", "t", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    got = L.clean(df, 3)
    assert got.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(i, f"{body} {i}") for i in range(5)] + [(9, body)]


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(1, "a b", "s")], "doc_id bigint, text string, source string")
    plan = L.verdicts(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
