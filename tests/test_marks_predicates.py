"""Marks and predicates on small literal frames: the NULL and tie cases."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidewater.functions import (
    Mark,
    drop_day,
    drop_today,
    drop_window,
    in_window,
    newer_than,
    read_composite_mark,
    read_day_mark,
)

D = date(2024, 1, 5)
SCHEMA = "d date, t int"


def test_null_time_on_newest_day_ranks_last(spark):
    raw = spark.createDataFrame([(D, None), (D, 2), (date(2024, 1, 4), 99)], SCHEMA)
    assert read_composite_mark(raw, "d", "t") == Mark(D, 2, True)


def test_null_time_alone_becomes_zero(spark):
    raw = spark.createDataFrame([(D, None), (date(2024, 1, 4), 99)], SCHEMA)
    assert read_composite_mark(raw, "d", "t") == Mark(D, 0, True)


def test_null_dates_are_ignored_and_empty_raw_gives_no_mark(spark):
    raw = spark.createDataFrame([(None, 5), (D, 1)], SCHEMA)
    assert read_composite_mark(raw, "d", "t").day == D
    empty = spark.createDataFrame([], SCHEMA)
    assert read_composite_mark(empty, "d", "t").empty
    assert read_day_mark(empty, "d").empty
    only_null = spark.createDataFrame([(None, 5)], SCHEMA)
    assert read_composite_mark(only_null, "d", "t").empty


def test_mark_that_is_not_a_date_raises(spark):
    raw = spark.createDataFrame([("garbage",)], "d string")
    with pytest.raises(ValueError):
        read_day_mark(raw, "d")


def test_timestamp_mark_is_cut_to_its_day(spark):
    raw = spark.sql("select timestamp_ntz'2024-01-05 13:14:15' as d")
    assert read_day_mark(raw, "d") == Mark(D, None, False)


def test_composite_predicate_equal_is_skipped_one_second_later_taken(spark):
    src = spark.createDataFrame(
        [(D, 100), (D, 101), (date(2024, 1, 6), 0), (date(2024, 1, 4), 999), (None, 999), (D, None)], SCHEMA
    )
    got = src.where(newer_than(Mark(D, 100, True), "d", "t")).collect()
    assert sorted((r.d, r.t) for r in got) == [(D, 101), (date(2024, 1, 6), 0)]


def test_day_predicate_is_inclusive_and_none_keeps_all(spark):
    src = spark.createDataFrame([(D, 1), (date(2024, 1, 4), 1), (None, 1)], SCHEMA)
    assert src.where(newer_than(Mark(D), "d")).count() == 1
    assert newer_than(Mark.none(), "d") is None


def test_window_end_is_midnight_for_timestamps(spark):
    df = spark.sql(
        "select * from values (timestamp_ntz'2024-01-31 00:00:00'), (timestamp_ntz'2024-01-31 10:00:00'), "
        "(cast(null as timestamp_ntz)) as v(d)"
    )
    assert df.where(in_window("d", "2024-01-01", "2024-01-31")).count() == 1


def test_deletes_never_match_null(spark):
    df = spark.createDataFrame([(D, 1), (None, 2)], SCHEMA)
    assert df.where(~drop_day("d", D)).count() == 1
    assert df.where(~drop_window("d", D, D)).count() == 1
    ing = spark.sql(
        "select * from values (timestamp_ntz'2024-01-05 10:00:00'), (cast(null as timestamp_ntz)) as v(_ingested_at)"
    )
    assert ing.where(~drop_today(D)).count() == 1
    assert ing.where(F.lit(True)).count() == 2


@pytest.mark.parametrize("text,day", [
    ("2024-01-05", D), ("2024-01-05 13:00:00", D), ("20240105", D), ("20240105 x", None), ("2024", None), ("2024-1-5", None), ("20241305", None), (None, None),
])
def test_text_marks_are_read_as_days(spark, text, day):
    from tidewater.functions import to_mark_day

    assert spark.createDataFrame([(text,)], "d string").select(to_mark_day(F.col("d"))).first()[0] == day
