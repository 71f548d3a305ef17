from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.testing import assertSchemaEqual

from tests.cases import CUS_ROWS, CUS_SCHEMA, MSG_ROWS, MSG_SCHEMA
from visitmap.operators import add_build_stamp, add_report_date, conform, explode_ids, link, project_contract
from visitmap.schemas import OUTPUT_COLS, output_schema


def exploded(spark):
    cus, msg = spark.createDataFrame(CUS_ROWS, CUS_SCHEMA), spark.createDataFrame(MSG_ROWS, MSG_SCHEMA)
    return add_build_stamp(add_report_date(explode_ids(link(cus, msg))), "2021-11-09 08:00:00.125")


def test_final_projection_has_the_contract_types(spark):
    df = exploded(spark)
    out = project_contract(df.select(*reversed(df.columns)))
    assertSchemaEqual(out.schema, output_schema(T.TimestampType()))
    assert out.count() == df.count()
    kept = [c for c in OUTPUT_COLS if "utc" not in c]
    assert sorted(map(tuple, out.select(kept).collect()), key=str) == sorted(map(tuple, df.select(kept).collect()), key=str)


@pytest.mark.parametrize("tz", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_times_are_utc_whatever_the_session_zone(spark, zone, tz):
    seconds = lambda c: F.unix_millis(c).alias(c)
    with zone(tz):
        text = project_contract(exploded(spark))
        got = text.select(*map(seconds, ("conversation_start_utc_ts", "conversation_end_utc_ts", "conversation_end_utc_date", "etl_build_mst_ts"))).distinct().collect()
        assert [tuple(r) for r in got] == [(1636320615750, 1636325100250, 1636243200000, 1636470000125)]
        wall = datetime(2021, 11, 7, 1, 30, 0, 5000)  # twice on New York's clocks
        ntz = spark.createDataFrame([("k", wall, wall, wall, "a", "s", None, "g", wall, date(2021, 11, 6))], output_schema(T.TimestampNTZType()))
        there = conform(ntz, output_schema(T.TimestampType()))
        row = there.select(seconds("conversation_end_utc_ts"), seconds("etl_build_mst_ts")).first()
        assert tuple(row) == (1636248600005, 1636273800005)
        back = conform(there, output_schema(T.TimestampNTZType()))
        assertSchemaEqual(back.schema, output_schema(T.TimestampNTZType()))
        assert back.collect() == ntz.collect()
