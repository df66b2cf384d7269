from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import keys


def values(spark, rows, names, column):
    frame = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    return [r[0] for r in frame.select(column()).collect()]


@pytest.mark.parametrize(
    "text, hour",
    [
        ("2024013005", datetime(2024, 1, 30, 5)),
        ("2024-01-30-05", datetime(2024, 1, 30, 5)),
        ("20240130", datetime(2024, 1, 30)),
        ("2024-01-30", datetime(2024, 1, 30)),
        (None, None),
        ("", None),
        ("2024013025", None),
        ("2024010225", None),
        ("20240230", None),
        (" 20240130", None),
        ("202401300512", None),
        ("2024-013005", None),
    ],
)
def test_hour_text(spark, text, hour):
    assert values(spark, [(text,)], ["d"], lambda: keys.hour_from_text(F.col("d"))) == [hour]
    day = hour.date() if hour else None
    assert values(spark, [(text,)], ["d"], lambda: keys.date_from_text(F.col("d"))) == [day]


def test_date_and_hour_bucket(spark):
    rows = [("20240130", "0"), ("20240130", "23"), ("20240130", "24"), ("20240130", None), ("20240230", "1"),
            ("2024-01-30", "7")]
    got = values(spark, rows, ["d", "h"], lambda: keys.hour_from_date_and_bucket(F.col("d"), F.col("h")))
    assert got == [datetime(2024, 1, 30), datetime(2024, 1, 30, 23), None, None, None, datetime(2024, 1, 30, 7)]


def test_month_and_day_parts(spark):
    rows = [("2024", "1"), ("2024", "12"), ("2024", "13"), ("2024", None), ("x", "1")]
    got = values(spark, rows, ["y", "m"], lambda: keys.month_from_parts(F.col("y"), F.col("m")))
    assert got == [date(2024, 1, 1), date(2024, 12, 1), None, None, None]
    rows = [("2024", "02", "29"), ("2023", "02", "29"), ("2024", "2", "1")]
    got = values(
        spark, rows, ["y", "m", "d"], lambda: keys.date_from_parts(F.col("y"), F.col("m"), F.col("d"))
    )
    assert got == [date(2024, 2, 29), None, date(2024, 2, 1)]


def test_first_fitting_format_wins(spark):
    formats = ("yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm", "yyyy-MM-dd")
    rows = [("12/1/2010 8:26",), ("2010-12-01 08:26:00",), ("2010-12-01",), ("1/12/2010 25:00",), ("soon",)]
    got = values(spark, rows, ["t"], lambda: keys.parse_timestamp(F.col("t"), formats))
    assert got == [datetime(2010, 12, 1, 8, 26)] * 2 + [datetime(2010, 12, 1), None, None]


@pytest.mark.parametrize(
    "pattern",
    ["yyyyMMddHH", "yyyy-MM-dd-HH", "yyyyMMdd", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss",
     "yyyy-MM-dd HH:mm:ss.SSSSSS", "dd.MM.yyyy HH:mm", "yyyyMMddHHmmss", "M/d/yyyy H:mm"],
)
def test_rearranged_text_reads_as_the_pattern_would(spark, pattern):
    """Times of every month and hour, and the same texts with fields out of range."""
    moments = spark.range(2000).select(
        F.timestamp_micros(F.lit(951_782_400_000_000) + F.col("id") * 354_321_987_654).alias("at")
    )
    written = moments.select(F.date_format("at", pattern).alias("text"))
    broken = written.select(F.translate("text", "01234", "97865").alias("text"))
    texts = written.union(broken)
    both = texts.select(
        keys.parse_timestamp(F.col("text"), (pattern,)).alias("mine"),
        F.try_to_timestamp("text", F.lit(pattern)).alias("theirs"),
    )
    assert both.where(~F.col("mine").eqNullSafe(F.col("theirs"))).count() == 0
    assert both.where("mine IS NOT NULL").count() >= 2000 and both.where("mine IS NULL").count() > 0
