from datetime import date, datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.functions import (
    as_number, days_between, decode, first_known, iif, like_any, like_text, moment, optional_filter, strip_breaks,
    valid_at,
)
from tallyhouse.streaming.highwater import day_aligned, resolve_window


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_unknown_condition_takes_the_second_branch(spark):
    unknown = F.lit(None).cast("int") == 1
    assert one(spark, iif(unknown, "yes", "no"), iif(F.lit(1) == 1, "yes", "no")) == ("no", "yes")


def test_first_known_keeps_the_type(spark):
    frame = spark.range(1).select(first_known(F.lit(None), 5, "bigint").alias("a"))
    assert frame.schema["a"].dataType.simpleString() == "bigint"
    assert frame.first().a == 5


def test_decode_null_and_unknown(spark):
    names = {1: "Primary", 2: "Add-on"}
    assert one(spark, *[decode(F.lit(c).cast("int"), names, "INVALID") for c in (1, 2, 9, None)]) == (
        "Primary", "Add-on", "INVALID", "INVALID")


def test_strip_breaks(spark):
    assert one(spark, strip_breaks(F.lit("a\r\nb\tc")), strip_breaks(F.lit(None).cast("string"))) == ("abc", None)


def test_as_number_skips_text(spark):
    assert one(spark, *[as_number(F.lit(v)) for v in ("12", "cash", "")]) == (12, None, None)


def test_days_between_counts_midnights(spark):
    late, early = moment(datetime(2024, 1, 1, 23, 59)), moment(datetime(2024, 1, 2, 0, 1))
    assert one(spark, days_between(late, early), days_between(early, late)) == (1, -1)


def test_moment_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, moment(datetime(2024, 3, 10, 2, 30)), moment(date(2024, 3, 10))) == (
            datetime(2024, 3, 10, 2, 30), datetime(2024, 3, 10))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_optional_filter_drops_nulls_either_way(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert [r.v for r in frame.filter(optional_filter(F.col("v"), None)).collect()] == ["a", "b"]
    assert [r.v for r in frame.filter(optional_filter(F.col("v"), "b")).collect()] == ["b"]


def test_like_case(spark):
    text = F.lit("one TRIAL day")
    assert one(spark, like_text(text, "%trial%"), like_text(text, "%trial%", case_insensitive=False)) == (True, False)
    assert one(spark, like_any(text, ["%guest%", "%trial%"])) == (True,)
    frame = spark.createDataFrame([("x",), (None,)], "v string")
    assert frame.filter(~like_any(F.col("v"), ["%guest%"])).count() == 1


def test_valid_at_bounds(spark):
    now = datetime(2024, 1, 10, 12)
    rows = [
        (1, 0, datetime(2024, 1, 10, 12), None), (2, 0, datetime(2024, 1, 1), datetime(2024, 1, 10, 12)),
        (3, 0, datetime(2024, 1, 10, 12, 1), None), (4, 0, datetime(2024, 1, 1), datetime(2024, 1, 10, 11)),
        (5, 1, datetime(2024, 1, 1), None), (6, None, datetime(2024, 1, 1), None), (7, 0, None, None),
    ]
    frame = spark.createDataFrame(rows, "id int, bad int, f timestamp_ntz, t timestamp_ntz")
    kept = frame.filter(valid_at(now, F.col("bad"), F.col("f"), F.col("t"))).collect()
    assert sorted(r.id for r in kept) == [1, 2]


def test_default_window_is_yesterday():
    now = datetime(2024, 3, 1, 9, 30)
    assert resolve_window(None, None, now) == (datetime(2024, 2, 29), datetime(2024, 3, 1))
    assert resolve_window(datetime(2024, 1, 1), None, now) == (datetime(2024, 1, 1), datetime(2024, 1, 2))
    assert resolve_window(datetime(2024, 1, 1), datetime(2024, 2, 1), now)[1] == datetime(2024, 2, 1)


_MINUTES = st.datetimes(datetime(2024, 1, 1), datetime(2024, 1, 6)).map(lambda d: d.replace(second=0, microsecond=0))


@settings(max_examples=200)
@given(low=_MINUTES, high=_MINUTES, at=_MINUTES)
def test_day_aligned_selects_the_same_days(low, high, at):
    midnight = datetime(at.year, at.month, at.day)
    aligned_low, aligned_high = day_aligned(low, high)
    assert (low <= midnight < high) == (aligned_low <= at < aligned_high)
