"""Text, number and date helpers."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from limitlens.functions import dates, numbers, text
from limitlens.operators import cache
from limitlens.operators.calendar import build_calendar, with_work_week


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("key", "tool", "day"),
    [
        ("readings/T1/2024-01-05.parquet", "T1", date(2024, 1, 5)),
        ("a/b/T2/2024-1-5.parquet", "T2", date(2024, 1, 5)),
        ("readings/T1/2024-02-30.parquet", "T1", None),
        ("readings/T1/2024-01-05.parquet.tmp", "T1", None),
        ("readings/T1/_DONE", "T1", None),
        ("2024-01-05.parquet", None, date(2024, 1, 5)),
    ],
)
def test_key_parse(spark, key, tool, day):
    assert value(spark, text.key_date(F.lit(key))) == day
    assert value(spark, text.key_tool(F.lit(key))) == tool


def test_file_names(spark):
    assert value(spark, text.chunk_tool(F.lit("raw/TOOL01_chunk_3.parquet.gzip"))) == "TOOL01"
    assert value(spark, text.clean_name(F.lit("raw/TOOL01.parquet.gzip"))) == "TOOL01"
    assert value(spark, text.clean_name(F.lit("LONGTOOL123"))) == "LONGTOOL123"


def test_size_text(spark):
    rows = ["Output:1row(295B)", "Output:12 rows(3.5kB)", "Output:7rows(1.2.3MB)", "x Output:1row(2B)", "Output:row(1B)", None]
    df = spark.createDataFrame([(r,) for r in rows], "t STRING")
    found = [(r.rows, r.size_value, r.size_unit) for r in text.parse_size_text(df, "t").collect()]
    assert found == [(1, 295.0, "B"), (12, 3.5, "kB"), (7, None, "MB")]


def test_lists(spark):
    assert value(spark, text.quoted_list(F.array(F.lit("a"), F.lit("b")))) == "'a','b'"
    assert value(spark, text.quoted_list(F.array().cast("array<string>"))) == ""
    assert value(spark, text.integer_list(F.array(F.lit(1.0), F.lit(2.9), F.lit(-2.9)))) == "1,2,-2"


def test_canonical_name(spark):
    assert value(spark, text.canonical_name(F.lit(" gas-flow  (1). "))) == "GAS_FLOW_1"


def test_numbers(spark):
    assert value(spark, numbers.ratio(F.lit(10), F.lit(3))) == 3.333
    assert value(spark, numbers.ratio(F.lit(10), F.lit(0))) is None
    assert value(spark, numbers.guarded_average(F.lit(10.0), F.lit(0))) == 0.0
    assert value(spark, numbers.guarded_average(F.lit(None).cast("double"), F.lit(0))) == 0.0
    assert value(spark, numbers.megabytes(F.lit(1048576))) == 1.0
    for raw, wanted in [(" 12.5 ", 12.5), ("n/a", None), ("", None), ("NaN", None), ("Infinity", None), ("-3", -3.0)]:
        assert value(spark, numbers.numeric_limit(F.lit(raw))) == wanted


def test_window_dates(spark):
    end = F.lit(date(2024, 3, 1))
    assert value(spark, dates.window_days(end, 3)) == [date(2024, 3, 1), date(2024, 2, 29), date(2024, 2, 28)]
    ends = spark.createDataFrame([(date(2024, 3, 1),)], "e DATE")
    found = cache.window_dates(ends, "e", 30).collect()
    assert len(found) == 30 and (found[0].d, found[0].days_back) == (date(2024, 3, 1), 0)
    assert min(r.d for r in found) == date(2024, 2, 1)


def test_bad_end_date_falls_back(spark):
    fallback = F.lit(date(2024, 1, 30))
    assert value(spark, dates.date_or(F.lit("2024-01-02"), fallback)) == date(2024, 1, 2)
    for bad in ("30/01/2024", "2024-13-01", ""):
        assert value(spark, dates.date_or(F.lit(bad), fallback)) == date(2024, 1, 30)
    assert value(spark, dates.date_or(F.lit(None).cast("string"), fallback)) == date(2024, 1, 30)


def test_past_time(spark):
    now = F.lit("2024-03-01 10:11:12.345678").cast("timestamp_ntz")
    assert value(spark, dates.past_time_text(now, 1)) == "2024-02-29 10:11:12"
    assert value(spark, dates.range_from_text(now, 30)) == "2024-01-31"
    assert value(spark, dates.range_to_text(now)) == "2024-03-01"


def test_calendar(spark):
    spans = spark.createDataFrame([(date(2023, 12, 27), date(2024, 1, 8))], "first_day DATE, last_day DATE")
    weeks = [tuple(r) for r in build_calendar(spans).orderBy("ww_start_date").collect()]
    assert weeks == [
        (date(2023, 12, 24), date(2023, 12, 30), "2023-52"),
        (date(2023, 12, 31), date(2024, 1, 6), "2024-01"),
        (date(2024, 1, 7), date(2024, 1, 13), "2024-02"),
    ]


def test_whole_last_day_belongs_to_its_week(spark):
    spans = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 10))], "first_day DATE, last_day DATE")
    times = [datetime(2024, 1, 6), datetime(2024, 1, 6, 23, 59, 59), datetime(2024, 1, 7), datetime(2025, 1, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t TIMESTAMP_NTZ")
    found = with_work_week(df, build_calendar(spans), F.col("t"))
    assert {r.t: r.year_ww for r in found.collect()} == dict(zip(times, ["2024-01", "2024-01", "2024-02", None]))
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
