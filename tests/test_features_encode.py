"""Scalar helpers, attribute selection, one-hot vocabulary, fill, error bands."""

import pytest

from ratewise.functions.scalars import packed_list_len
from ratewise.operators import encode as E
from ratewise.operators import evaluate as EV
from ratewise.operators import features as FT

from conftest import rows


def test_packed_list_len(spark):
    df = spark.createDataFrame([("None",), ("",), ("2015",), ("2015,2016",)], "s string")
    assert [r[0] for r in rows(df.select(packed_list_len("s")))] == [0.0, 1.0, 1.0, 2.0]


def test_onehot_vocabulary(spark):
    train = spark.createDataFrame([("u", "1", "a"), ("u", "2", "b"), ("u", "3", None)],
                                  "user_id string, business_id string, colour string")
    vocab = E.fit_vocabulary(train, ["colour"])
    assert vocab == {"colour": ["a", "b", "unk"]}
    enc = E.onehot_transform(train, vocab)
    assert [c for c in enc.columns if c.startswith("colour")] == ["colourb", "colourunk"]  # 'a' dropped
    req = spark.createDataFrame([("u", "9", "z"), ("u", "8", "a")],
                                "user_id string, business_id string, colour string")
    got = rows(E.onehot_transform(req, vocab), "colourb", "colourunk")
    assert got == [(0, 0), (0, 0)]   # unseen and dropped-first categories are all zero


def _items(spark, n_values, n_with, total):
    data = []
    for k in range(total):
        attrs = {"key": f"v{k % n_values}"} if k < n_with else None
        data.append((str(k), attrs))
    return spark.createDataFrame(data, "business_id string, attributes map<string,string>")


@pytest.mark.parametrize("n_values,n_with,total,kept", [
    (10, 40, 40, True), (11, 44, 44, False),
    (2, 20, 100, True),    # coverage exactly 0.2 is kept
    (2, 19, 100, False),
])
def test_attribute_rule(spark, n_values, n_with, total, kept):
    keys = E.selected_keys(_items(spark, n_values, n_with, total))
    assert (keys == ["key"]) == kept


def test_fill_missing(spark):
    fb = spark.createDataFrame([(9.0, 8.0)], "bns_avg double, usr_avg double")
    df = spark.createDataFrame([("u", "b", None, None, None)],
                               "user_id string, business_id string, bns_avg double, usr_avg double, likes long")
    (r,) = FT.fill_missing(df, fb).collect()
    assert (r.bns_avg, r.usr_avg, r.likes) == (9.0, 0.0, 0.0)
    (r,) = FT.fill_missing(df, fb, user_fallback=True).collect()
    assert (r.bns_avg, r.usr_avg, r.likes) == (9.0, 8.0, 0.0)


def test_unique_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "business_id string")
    with pytest.raises(ValueError, match="occurs 2 times"):
        FT.assert_unique(df, "business_id", "items")
    assert FT.assert_unique(df.distinct(), "business_id", "items").count() == 2


def test_error_bands(spark):
    errs = [0.0, 0.99, 1.0, 4.0, 6.75]
    pred = spark.createDataFrame([(str(i), "b", 1.0 + e) for i, e in enumerate(errs)],
                                 "user_id string, business_id string, prediction double")
    truth = spark.createDataFrame([(str(i), "b", 1.0) for i in range(len(errs))],
                                  "user_id string, business_id string, stars double")
    got = dict(rows(EV.error_bands(pred, truth), "band", "n"))
    assert got == {0: 2, 1: 1, 2: 0, 3: 0, 4: 2}


def test_blend_aligns_by_key(spark):
    a = spark.createDataFrame([("u", "x", 5.0), ("u", "y", 1.0)], "user_id string, business_id string, prediction double")
    b = spark.createDataFrame([("u", "y", 3.0), ("u", "x", 2.0)], "user_id string, business_id string, prediction double")
    got = dict((k, v) for _, k, v in rows(EV.blend(a, b, 0.1)))
    assert got["x"] == pytest.approx(0.1 * 5 + 0.9 * 2)
    assert got["y"] == pytest.approx(0.1 * 1 + 0.9 * 3)
    one = dict((k, v) for _, k, v in rows(EV.blend(a, b, 1.0)))
    assert one == {"x": 5.0, "y": 1.0}


def test_checkin_slots_is_map_size(spark):
    df = spark.createDataFrame([("b", {"1-2": 5, "3-4": 7}), ("c", None)],
                               "business_id string, time map<string,int>")
    assert dict(rows(FT.checkin_slots(df))) == {"b": 2, "c": 0}
