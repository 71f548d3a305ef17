"""The whole job on the original job's input types: text times, and TIMESTAMP instants."""

from datetime import date, datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.testing import assertSchemaEqual

from tests.cases import CUS_ROWS, CUS_SCHEMA, DAY, LINKED_ROWS, MSG_ROWS, MSG_SCHEMA
from visitmap import DateWindow, build_visit_map
from visitmap.schemas import OUTPUT_COLS, customer_schema, messaging_schema, output_schema


def test_text_inputs_like_the_original_tests(spark):
    cus = spark.createDataFrame(CUS_ROWS, CUS_SCHEMA)
    msg = spark.createDataFrame(MSG_ROWS, MSG_SCHEMA).withColumn("conversation_end_utc_date", F.lit(DAY))
    out = build_visit_map(cus, msg, DateWindow(DAY, DAY), build_ts="2021-11-08 01:02:03.456")
    assert out.columns == OUTPUT_COLS
    rows = out.collect()
    got = sorted({(r.parent_contact_id, r.visit_guid) for r in rows}, key=str)
    assert got == sorted({(r[0], g) for r in LINKED_ROWS for g in r[4] or [None]}, key=str)
    assert {r.rpt_mst_date for r in rows} == {date(2021, 11, 6)}
    assertSchemaEqual(out.schema, output_schema(T.TimestampType()))
    # Text in, no time type to follow: the stamp is a TIMESTAMP instant.
    assert out.schema["etl_build_mst_ts"].dataType == T.TimestampType()
    assert len({r.etl_build_mst_ts for r in rows}) == 1
    both = build_visit_map(cus, msg, DateWindow(DAY, DAY), sides="both", build_ts="2021-11-08")
    assert both.count() == len(rows)


def _instant(s):
    return datetime.fromisoformat(s).replace(tzinfo=timezone.utc)


def test_timestamp_instants_same_answer_in_every_zone(spark, zone):
    ts = T.TimestampType()
    cus_rows = [("a", 1_000, 1_060, "2024-01-15 06:59:59", ["g1"]),
                ("b", 1_000, 1_060, "2024-01-15 07:00:00", ["g2", "g2"]),
                ("c", 1_000, 1_060, "2024-01-16 10:00:00", None)]
    msg_rows = [("a", 7, "app", "SMS", None), ("b", 7, "app", "SMS", "Desktop"), ("c", None, "web", "SMS", None)]
    answers = []
    for tz in ["UTC", "Asia/Tokyo", "America/New_York"]:
        with zone(tz):
            cus = spark.createDataFrame(
                [(c, int(_instant(d).timestamp()), g) for c, _, _, d, g in cus_rows],
                "conversation_id string, s long, visit_guids array<string>",
            ).select("conversation_id", F.timestamp_seconds("s").alias("conversation_start_utc_ts"),
                     F.timestamp_seconds("s").alias("conversation_end_utc_ts"),
                     F.timestamp_seconds("s").alias("conversation_end_utc_date"), "visit_guids")
            assert cus.schema == customer_schema(ts)
            msg = spark.createDataFrame([r + (None,) for r in msg_rows], messaging_schema(ts))
            out = build_visit_map(cus, msg, DateWindow("2024-01-14", "2024-01-16", "whole_days"),
                                  build_ts=datetime(2024, 2, 1, 12, 0))
            assert out.schema["etl_build_mst_ts"].dataType == ts
            answers.append(sorted(
                ((r.parent_contact_id, r.visit_guid, r.rpt_mst_date, r.s, r.b)
                 for r in out.select("parent_contact_id", "visit_guid", "rpt_mst_date",
                                     F.unix_seconds("conversation_end_utc_date").alias("s"),
                                     F.unix_seconds("etl_build_mst_ts").alias("b")).collect()),
                key=str))
    assert answers[0] == answers[1] == answers[2]
    by_key = {k: d for k, _, d, _, _ in answers[0]}
    assert by_key == {"7-a": date(2024, 1, 14), "7-b": date(2024, 1, 15), None: date(2024, 1, 16)}
    assert {b for *_, b in answers[0]} == {int(datetime(2024, 2, 1, 19, 0, tzinfo=timezone.utc).timestamp())}
