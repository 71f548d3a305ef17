from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.cases import LINKED_ROWS, LINKED_SCHEMA
from visitmap.functions.timefns import build_stamp_literal, stamp_text
from visitmap.operators import add_build_stamp, add_report_date, dedupe, overwrite_with_build_time

ZONES = ["UTC", "Asia/Tokyo", "America/New_York"]

# (UTC wall clock, expected MST date): 07:00Z starts the MST day, winter and summer alike.
BOUNDARY = [
    ("2024-01-15 06:59:59", date(2024, 1, 14)),
    ("2024-01-15 07:00:00", date(2024, 1, 15)),
    ("2024-07-15 06:59:59", date(2024, 7, 14)),
    ("2024-07-15 07:00:00", date(2024, 7, 15)),
    ("2019-10-21 00:00:00", date(2019, 10, 20)),
]


def test_report_date_on_text_midnight(spark):
    df = spark.createDataFrame(LINKED_ROWS, LINKED_SCHEMA).withColumn(
        "conversation_end_utc_date", F.lit("2019-10-21"))
    out = add_report_date(df)
    assert out.schema["rpt_mst_date"].dataType == T.DateType()
    assert {r.rpt_mst_date for r in out.collect()} == {date(2019, 10, 20)}


@pytest.mark.parametrize("tz", ZONES)
def test_report_date_same_under_every_session_zone(spark, zone, tz):
    wall = spark.createDataFrame([(w,) for w, _ in BOUNDARY], "w string")
    typed = wall.select(
        F.col("w"),
        F.col("w").cast("timestamp_ntz").alias("ntz"),
        # The instant whose UTC wall clock is w, built without the session zone.
        F.timestamp_seconds(F.unix_seconds(F.to_utc_timestamp(F.col("w").cast("timestamp"), "UTC"))).alias("ltz"),
    )
    expected = {w: d for w, d in BOUNDARY}
    with zone(tz):
        # Instants: build from epoch seconds so the row means the same instant in every zone.
        epoch = {w: int(datetime.fromisoformat(w).replace(tzinfo=timezone.utc).timestamp()) for w, _ in BOUNDARY}
        inst = spark.createDataFrame([(w, s) for w, s in epoch.items()], "w string, s long").select(
            "w", F.timestamp_seconds("s").alias("ltz"))
        for col, df in (("w", typed), ("ntz", typed), ("ltz", inst)):
            rows = add_report_date(df.select("w", col), source_col=col).collect()
            assert {r.w: r.rpt_mst_date for r in rows} == expected, (tz, col)


def test_report_date_on_date_column(spark):
    df = spark.createDataFrame([(date(2024, 3, 1),)], "d date")
    assert add_report_date(df, "d").first().rpt_mst_date == date(2024, 2, 29)


def test_report_date_rejects_numbers(spark):
    with pytest.raises(TypeError):
        add_report_date(spark.range(1), "id")


def test_build_stamp_fixed_value_same_on_every_row(spark):
    df = spark.createDataFrame(LINKED_ROWS, LINKED_SCHEMA)
    out = add_build_stamp(df, "2024-02-01 12:34:56.789123")
    vals = {r.etl_build_mst_ts for r in out.collect()}
    assert len(vals) == 1
    # Text input has no timestamp type to follow: the stamp is an instant (TIMESTAMP).
    assert out.schema["etl_build_mst_ts"].dataType == T.TimestampType()
    assert dedupe(out).count() == dedupe(df).count()


def test_build_stamp_ntz_is_mst_wall_clock_in_ms(spark, zone):
    df = spark.range(3).select(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("conversation_end_utc_ts"))
    for tz in ZONES:
        with zone(tz):
            out = add_build_stamp(df, datetime(2024, 2, 1, 12, 34, 56, 789999))
            assert out.schema["etl_build_mst_ts"].dataType == T.TimestampNTZType()
            assert {r.etl_build_mst_ts for r in out.collect()} == {datetime(2024, 2, 1, 12, 34, 56, 789000)}


def test_build_stamp_instant_from_aware_time(spark, zone):
    aware = datetime(2024, 2, 1, 19, 0, 0, tzinfo=timezone.utc)       # 12:00 MST
    assert stamp_text(aware) == "2024-02-01 12:00:00.000"
    with zone("UTC"):
        v = spark.range(1).select(
            F.unix_seconds(build_stamp_literal(aware, T.TimestampType())).alias("s")).first().s
    assert v == int(aware.timestamp())


def test_overwrite_with_build_time_keeps_type(spark):
    df = spark.range(2).select(F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("conversation_end_utc_ts"))
    out = overwrite_with_build_time(df, "conversation_end_utc_ts", "2024-02-01 12:00:00")
    assert out.schema["conversation_end_utc_ts"].dataType == T.TimestampNTZType()
    assert {r.conversation_end_utc_ts for r in out.collect()} == {datetime(2024, 2, 1, 12, 0)}


def test_default_stamp_reads_clock_once(spark):
    df = spark.range(100).select(F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("conversation_end_utc_ts"))
    assert add_build_stamp(df).select("etl_build_mst_ts").distinct().count() == 1
