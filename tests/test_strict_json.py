"""JSON-lines sources: what stops a job, what is left out, what is kept."""

import pytest

from ratewise.sources import files as FS

GOOD = ['{"business_id":"a","stars":1.5,"attributes":{"k":"v"}}', "  ", '{"business_id":"b","other":[1,{"x":2}]}', "",
        '  {"business_id":"c","stars":null}  ', "{}", '{"business_id":"d","business_id":"e"}', '{"business_id":"f","latitude":NaN}']
VALUES = ['{"business_id":"a","stars":"x"}', '{"stars":"1.5"}', '{"review_count":1.5}', '{"review_count":99999999999999999999}',
          '{"attributes":3}', '{"stars":true}']
RECORDS = ['{"business_id":"a"', '{"business_id":"a"} x', '{"business_id":"a"} {"business_id":"b"}',
           '{"business_id":"a"}, {"business_id":"b"}', "null", '"x"', "[1]", "5", "{'business_id':'a'}", "business_id", "{", "}", '{"business_id":"a"}]']


def _file(tmp_path, lines, name="f.json"):
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path / name)


def test_good_lines_are_read(spark, tmp_path):
    path = _file(tmp_path, GOOD)
    for mode in ("fail", "drop"):
        rows = FS.read_items(spark, path, mode).collect()
        assert [r.business_id for r in rows] == ["a", "b", "c", None, "e", "f"]
        assert rows[0].stars == 1.5 and rows[0].attributes == {"k": "v"} and rows[1].stars is None
    assert FS.count_bad_json_rows(spark, path, FS.ITEM_SCHEMA) == 0
    assert FS.read_items(spark, path).schema == FS.ITEM_SCHEMA


@pytest.mark.parametrize("line", VALUES + RECORDS)
def test_a_bad_line_stops_the_job(spark, tmp_path, line):
    path = _file(tmp_path, [*GOOD, line])
    df = FS.read_items(spark, path)
    for use in (df.collect, df.count, df.select("latitude").collect, df.where("business_id = 'b'").collect):
        with pytest.raises(Exception, match="bad record"):
            use()


def test_bad_lines_are_dropped_counted_and_kept_apart(spark, tmp_path):
    path = _file(tmp_path, [x for k in range(3) for x in (*GOOD, *VALUES, *RECORDS)])
    kept = [r.business_id for r in FS.read_items(spark, path, "drop").collect()]
    assert kept == ["a", "b", "c", None, "e", "f"] * 3
    bad = FS.bad_json_rows(spark, path, FS.ITEM_SCHEMA).collect()
    assert sorted(r.record for r in bad) == sorted((VALUES + RECORDS) * 3)
    assert {r.record for r in bad if r.reason == "value"} >= set(VALUES)
    out = str(tmp_path / "bad")
    assert FS.quarantine_json(spark, path, FS.ITEM_SCHEMA, out).count() == 18
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted((VALUES + RECORDS) * 3)


def test_mode_is_checked_and_empty_files_are_empty(spark, tmp_path):
    path = _file(tmp_path, [""])
    with pytest.raises(ValueError, match="on_bad_rows"):
        FS.read_tips(spark, path, "ignore")
    for read in (FS.read_tips, FS.read_photos, FS.read_checkins, FS.read_reviews, FS.read_users):
        assert read(spark, path).collect() == []


def test_a_line_is_parsed_once(spark, tmp_path):
    plan = FS.read_items(spark, _file(tmp_path, GOOD)).select("stars", "latitude")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
