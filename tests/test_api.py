"""Small API contracts: argument checks, SQL dedupe of the join, rolling run."""

from datetime import date, datetime

import pytest

from tests.cases import CUS_ROWS, CUS_SCHEMA, MSG_ROWS, MSG_SCHEMA
from visitmap import DateWindow, build_visit_map
from visitmap.operators import dedupe, distinct_sql, link
from visitmap.plans import rolling_run
from visitmap.session import scratch_path
from visitmap.sources import load_inputs, read_target


def test_bad_arguments(spark):
    cus = spark.createDataFrame(CUS_ROWS, CUS_SCHEMA)
    msg = spark.createDataFrame(MSG_ROWS, MSG_SCHEMA)
    with pytest.raises(ValueError):
        build_visit_map(cus, msg, None, sides="right")
    with pytest.raises(ValueError):
        build_visit_map(cus, msg, None, prededupe="sometimes")


def test_sql_dedupe_of_the_join_equals_dedupe_of_link(spark):
    cus = spark.createDataFrame(CUS_ROWS + CUS_ROWS[:2], CUS_SCHEMA)
    msg = spark.createDataFrame(MSG_ROWS + MSG_ROWS[:1], MSG_SCHEMA)
    a = distinct_sql(spark, link(cus, msg))
    b = dedupe(link(cus, msg))
    assert a.columns == b.columns
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_rolling_run_writes_the_lookback_report_days(spark):
    from visitmap.schemas import output_schema
    from pyspark.sql import types as T

    cus, msg = load_inputs(spark, "/root/testdata/sf0.001", "events")
    path = scratch_path(spark, "t-rolling")
    window = rolling_run(cus, msg, path, as_of="2024-01-20", lookback_days=3, build_ts="2024-02-01")
    assert (window.start, window.end, window.mode) == (date(2024, 1, 16), date(2024, 1, 19), "report_days")
    back = read_target(spark, path, T.TimestampNTZType())
    assert back.schema == output_schema(T.TimestampNTZType())
    got = {r.rpt_mst_date for r in back.select("rpt_mst_date").distinct().collect()}
    assert got == set(window.report_dates())
    expected = build_visit_map(cus, msg, DateWindow("2024-01-16", "2024-01-19", "report_days"), build_ts="2024-02-01")
    assert back.exceptAll(expected).count() == 0 and expected.exceptAll(back).count() == 0


def test_bloom_filter_sizing():
    from visitmap.session import bloom_filter_conf

    conf = bloom_filter_conf(10_000_000)
    bits = int(conf["spark.sql.optimizer.runtime.bloomFilter.numBits"])
    assert 7.2 * 10_000_000 < bits < 7.4 * 10_000_000          # about 7.3 bits per key at 3%
    assert conf["spark.sql.optimizer.runtime.bloomFilter.expectedNumItems"] == "10000000"
    capped = bloom_filter_conf(10**10)
    assert int(capped["spark.sql.optimizer.runtime.bloomFilter.maxNumBits"]) == 64 * 2**20 * 8


def test_sized_bloom_filter_in_plan(spark):
    from visitmap.session import bloom_filter_conf

    cus, msg = load_inputs(spark, "/root/testdata/sf0.001")
    conf = {**bloom_filter_conf(2_000_000),
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1k"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = build_visit_map(cus, msg, DateWindow("1997-01-01", "1997-01-11"))._jdf.queryExecution() \
            .optimizedPlan().toString()
        assert "might_contain" in plan
        assert conf["spark.sql.optimizer.runtime.bloomFilter.numBits"] in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_backfill_run_keeps_dates_outside_its_range(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from visitmap.plans import backfill_run

    cus, msg = load_inputs(spark, "/root/testdata/sf0.001", "events")
    path = scratch_path(spark, "t-backfill")
    rolling_run(cus, msg, path, as_of="2024-01-25", lookback_days=2, build_ts="2024-02-01 00:00:00")
    window = backfill_run(cus, msg, path, as_of="2024-01-10", start="2024-01-01", build_ts="2024-02-02 00:00:00")
    assert (window.start, window.end) == (date(2024, 1, 1), date(2024, 1, 9))
    back = read_target(spark, path, T.TimestampNTZType())
    stamps = {r.rpt_mst_date: r.s for r in back.groupBy("rpt_mst_date").agg(F.max("etl_build_mst_ts").alias("s")).collect()}
    assert {d for d, s in stamps.items() if s == datetime(2024, 2, 2)} == set(window.report_dates()) & set(stamps)
    assert {d for d, s in stamps.items() if s == datetime(2024, 2, 1)} == {date(2024, 1, 22), date(2024, 1, 23),
                                                                            date(2024, 1, 24)}


def test_recommended_settings_are_real_spark_settings(spark):
    """Spark ignores a misspelled key silently; every recommended key must be one it knows."""
    from visitmap.session import RECOMMENDED_CONF, bloom_filter_conf

    for key in {**RECOMMENDED_CONF, **bloom_filter_conf(1000)}:
        assert spark.conf.isModifiable(key), key
