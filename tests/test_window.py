from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from visitmap.functions.window import HISTORY_START, DateWindow

W = DateWindow("2024-01-10", "2024-01-12")


def _ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.fixture
def times(spark):
    rows = [
        (1, "2024-01-09 23:59:59"),
        (2, "2024-01-10 00:00:00"),
        (3, "2024-01-10 06:59:59"),
        (4, "2024-01-10 07:00:00"),
        (5, "2024-01-12 00:00:00"),
        (6, "2024-01-12 10:00:00"),
        (7, "2024-01-13 00:00:00"),
        (8, "2024-01-13 06:59:59"),
        (9, "2024-01-13 07:00:00"),
    ]
    epoch = [(i, int(datetime.fromisoformat(w).replace(tzinfo=timezone.utc).timestamp())) for i, w in rows]
    df = spark.createDataFrame(rows, "id int, w string").join(
        spark.createDataFrame(epoch, "id int, s long"), "id")
    return df.select("id", "w", F.col("w").cast("timestamp_ntz").alias("ntz"),
                     F.timestamp_seconds("s").alias("ltz"), F.to_date(F.col("w").cast("timestamp_ntz")).alias("d"))


@pytest.mark.parametrize("col", ["ntz", "ltz"])
def test_closed_window_drops_rest_of_last_day(spark, times, zone, col):
    for tz in ["UTC", "Asia/Tokyo", "America/New_York"]:
        with zone(tz):
            assert _ids(W.apply(times, col)) == [2, 3, 4, 5], (col, tz)


def test_closed_window_on_text_compares_as_text(times):
    # '2024-01-12 00:00:00' sorts after '2024-01-12': text drops the whole last day.
    assert _ids(W.apply(times, "w")) == [2, 3, 4]


def test_closed_window_on_date_keeps_last_day(times):
    assert _ids(W.apply(times, "d")) == [2, 3, 4, 5, 6]


@pytest.mark.parametrize("col", ["ntz", "ltz", "w", "d"])
def test_whole_days(times, col):
    assert _ids(W.with_mode("whole_days").apply(times, col)) == [2, 3, 4, 5, 6]


@pytest.mark.parametrize("col", ["ntz", "ltz", "w"])
def test_report_days(times, col):
    assert _ids(W.with_mode("report_days").apply(times, col)) == [4, 5, 6, 7, 8]


def test_report_days_on_date_column(times):
    # A DATE is midnight UTC, which belongs to the previous report day.
    assert _ids(W.with_mode("report_days").apply(times, "d")) == [5, 6, 7, 8, 9]


def test_window_filter_reaches_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.lit("2024-01-11 00:00:00").cast("timestamp_ntz").alias("ts"),
                           F.lit("x").alias("other")).write.parquet(path)
    df = W.apply(spark.read.parquet(path), "ts").select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-10T00:00)" in plan
    assert "ReadSchema: struct<id:bigint,ts:timestamp_ntz>" in plan


def test_rolling_and_backfill_bounds():
    r = DateWindow.rolling("2024-01-15")
    assert (r.start, r.end) == (date(2024, 1, 4), date(2024, 1, 14))
    assert len(r.report_dates()) == 11
    b = DateWindow.backfill("2024-01-15")
    assert (b.start, b.end) == (HISTORY_START, date(2024, 1, 14))
    assert DateWindow.rolling().end < date.today() + (date.today() - date.today()).__class__(days=1)


def test_bad_windows():
    with pytest.raises(ValueError):
        DateWindow("2024-01-02", "2024-01-01")
    with pytest.raises(ValueError):
        DateWindow("2024-01-01", "2024-01-02", "open")
