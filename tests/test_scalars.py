import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import dates, jsonx, keys, numbers, text


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("raw, day", [
    ("/Date(1773360000000+0000)/", dt.date(2026, 3, 13)),
    ("/Date(1773360000000+1000)/", dt.date(2026, 3, 13)),
    ("/Date(1774483200000)/", dt.date(2026, 3, 26)),
    ("/Date(-86400000)/", dt.date(1969, 12, 31)),
    ("not a date", None), ("", None), (None, None),
])
def test_epoch_date(spark, raw, day):
    assert one(spark, raw, dates.epoch_date) == day
    stamp = one(spark, raw, dates.epoch_timestamp)
    assert (stamp.date() if stamp else None) == day


def test_epoch_timestamp_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, "/Date(1773360000000+0000)/", dates.epoch_timestamp) == dt.datetime(2026, 3, 13)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_iso(spark):
    assert one(spark, "2026-03-13T00:00:00", dates.iso_date) == dt.date(2026, 3, 13)
    assert one(spark, "2026-03-13T10:11:12", dates.iso_datetime) == dt.datetime(2026, 3, 13, 10, 11, 12)
    assert one(spark, "2026-03-13T10:11:12.123456789Z", dates.iso_datetime) == dt.datetime(2026, 3, 13, 10, 11, 12, 123456)
    assert one(spark, "rubbish", dates.iso_date) is None
    assert one(spark, "199705", dates.iso_datetime) is None


@pytest.mark.parametrize("raw, day", [
    ("2024-02-29", dt.date(2024, 2, 29)), ("2023-02-29", None), ("2024-02-29T23:59:59", dt.date(2024, 2, 29)),
    ("202402", dt.date(2024, 2, 1)), ("202413", None), ("n/a", None), (None, None),
])
def test_any_date(spark, raw, day):
    assert one(spark, raw, dates.any_date) == day


@pytest.mark.parametrize("report, month, day, start", [
    ("2024-01-30", 12, 31, "2024-01-01"), ("2024-01-30", 1, 15, "2024-01-16"), ("2024-01-10", 1, 15, "2023-01-16"),
    ("2024-01-30", 2, 29, "2023-03-01"), ("2024-03-01", 2, 29, "2024-03-01"), ("2024-02-29", 2, 29, "2023-03-01"),
])
def test_fiscal_year_start(spark, report, month, day, start):
    got = one(spark, report, lambda c: dates.fiscal_year_start(c.cast("date"), F.lit(month), F.lit(day)))
    assert got == dt.date.fromisoformat(start)


def test_json_scalar_tells_nested_from_text(spark):
    doc = '{"a": 1, "o": {"x": 2}, "l": [1], "s": "{not json", "t": "[1]", "n": null, "b": true}'
    get = lambda p: one(spark, doc, lambda c: jsonx.json_scalar(jsonx.parsed(c), p))
    assert get("$.a") == "1" and get("$.s") == "{not json" and get("$.t") == "[1]" and get("$.b") == "true"
    assert get("$.o") is None and get("$.l") is None and get("$.n") is None and get("$.zz") is None
    assert one(spark, doc, lambda c: jsonx.first_scalar(jsonx.parsed(c), "$.o", "$.l", "$.a")) == "1"
    assert one(spark, "{broken", lambda c: jsonx.json_scalar(jsonx.parsed(c), "$.a")) is None


def test_text(spark):
    assert one(spark, "  ", text.blank_to_null) is None
    assert one(spark, " x ", text.is_true_word) is True
    assert one(spark, None, text.is_true_word) is False
    assert one(spark, "Ab-12c", text.normalize_identifier) == "A12"
    assert one(spark, "Ab-12c", lambda c: text.normalize_identifier(c, upper_first=True)) == "AB12C"
    assert one(spark, "000000000", text.real_identifier) is None
    assert one(spark, "a", lambda c: text.code_label(c, F.lit(None).cast("string"))) == "a"
    assert one(spark, "1", lambda c: text.segment_code(c, F.lit(None).cast("string"), F.lit("3"), F.lit(None).cast("string"))) == "1--3"
    assert one(spark, "a b/C", text.path_segment) == "a_b_c"


def test_numbers_and_keys(spark):
    null = F.lit(None).cast("int")
    df = spark.range(1)
    assert df.select(numbers.strict_greatest(F.lit(1), null)).first()[0] is None
    assert df.select(numbers.strict_greatest(F.lit(1), F.lit(3))).first()[0] == 3
    assert df.select(numbers.safe_divide(F.lit(1), F.lit(0))).first()[0] is None
    assert df.select(keys.surrogate_key(F.lit("a"), null)).first()[0] is None
    assert df.select(keys.readable_key(F.lit("a"), F.lit(2))).first()[0] == "a|2"
