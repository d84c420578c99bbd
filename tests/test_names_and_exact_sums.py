"""One-hot names that stay apart, and sums beyond double precision."""

import pytest
from pyspark.sql import functions as F

from ratewise.functions.moments import moment_columns, scatter
from ratewise.operators import cf
from ratewise.operators import encode as E
from ratewise.operators import features as FT
from ratewise.operators import model as M


def test_dotted_and_quoted_keys(spark):
    rows = [(1, {"a.b": "x", "c`d": "1"}), (2, {"a.b": "y.z", "c`d": "2"}), (3, {"a.b": "x"})]
    items = spark.createDataFrame(rows, "business_id bigint, attributes map<string,string>")
    keys = E.selected_keys(items)
    assert keys == ["a.b", "c`d"]
    wide = E.item_attributes_wide(items, keys)
    vocab = E.fit_vocabulary(wide, keys)
    assert vocab == {"a.b": ["x", "y.z"], "c`d": ["1", "2", "unk"]}
    hot = E.onehot_transform(wide, vocab)
    assert hot.columns == ["business_id", "a.by.z", "c`d2", "c`dunk"]
    fallback = spark.createDataFrame([(1.0,)], "bns_avg double")
    filled = FT.fill_missing(hot, fallback)
    assert sorted(tuple(r) for r in filled.collect()) == [(1, 0.0, 0.0, 0.0), (2, 1.0, 1.0, 0.0), (3, 0.0, 0.0, 1.0)]
    vectors = M.assemble(filled, hot.columns[1:])
    assert vectors.columns == [*filled.columns, "features"]
    assert sorted(tuple(r.features) for r in vectors.collect()) == [(0, 0, 0), (0, 0, 1), (1, 1, 0)]


@pytest.mark.parametrize("vocab, taken, names", [
    ({"ab": ["-", "c"], "a": ["-", "bc"]}, (), ["a=bc", "ab=c"]),
    ({"a": ["-", "B"], "A": ["-", "b"]}, (), ["A=b", "=a=B"]),
    ({"st": ["-", "ars"]}, ("Stars",), ["st=ars"]),
    ({"a": ["-", "=b", "b"], "a=": ["-", "b"]}, (), ["a==b", "ab", "a==b"]),
    ({"x": ["-", "1", "2"]}, ("y",), ["x1", "x2"])])
def test_names_are_injective(vocab, taken, names):
    got = [n for _, _, n in E.onehot_names(vocab, taken=taken)]
    low = [n.lower() for n in got]
    assert len(set(low)) == len(low) and not set(low) & {t.lower() for t in taken}
    if len(set(x.lower() for x in names)) == len(names):
        assert got == names


def _sums(spark, counts):
    """Exact sums of values given as {value: how many}, as doubles."""
    n = sum(counts.values())
    s = [float(sum(c * v ** k for v, c in counts.items())) for k in range(1, 5)]
    return spark.createDataFrame([(n, *s)], "n bigint, s1 double, s2 double, s3 double, s4 double")


@pytest.mark.parametrize("value", [0.5, 1.5, 3.5, 4.5, 5.0])
@pytest.mark.parametrize("n", [3, 20_000_003, 19 * 10 ** 6 + 7, 3 * 10 ** 9 + 1, 10 ** 13 + 3])
def test_equal_ratings_have_no_variance_at_any_size(spark, value, n):
    df = _sums(spark, {value: n})
    c = [F.col(x) for x in ("n", "s1", "s2", "s3", "s4")]
    names = {"avg": "a", "std": "s", "skew": "w", "kurt": "k"}
    assert df.select(scatter(c[0].cast("double"), c[1], c[2])).first()[0] == 0.0
    row = df.select(*moment_columns(*c, names)).first()
    assert (row.a, row.s, row.w, row.k) == (value, 0.0, 0.0, 0.0 if n > 3 else None)
    pearson = df.select(cf.pearson(c[0], c[1], c[1], c[2], c[2], c[2])).first()[0]
    assert pearson == 0.0


def test_one_other_rating_is_seen(spark):
    for n in (10, 10 ** 8, 10 ** 12):
        df = _sums(spark, {4.5: n, 4.0: 1})
        got = df.select(scatter(F.col("n").cast("double"), F.col("s1"), F.col("s2"))).first()[0]
        assert got == n / 4


def test_small_sums_and_real_values_as_before(spark):
    df = spark.createDataFrame([(3.0, 6.1, 14.3), (5.0e8, 1.1e9, 2.7e9 + 0.3), (None, 1.0, 1.0)], "n double, s1 double, s2 double")
    got = [r[0] for r in df.select(scatter(F.col("n"), F.col("s1"), F.col("s2"))).collect()]
    assert got == [3.0 * 14.3 - 6.1 * 6.1, 5.0e8 * (2.7e9 + 0.3) - 1.1e9 * 1.1e9, None]
