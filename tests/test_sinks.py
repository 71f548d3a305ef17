import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.functions.window import DateWindow
from visitmap.operators import conform
from visitmap.plans.rerun import run_window
from visitmap.schemas import OUTPUT_COLS, export_schema, output_schema
from visitmap.session import scratch_path
from visitmap.sinks import (
    create_export_table,
    create_target_table,
    export_orc,
    insert_overwrite_by_name,
    overwrite_partitions,
    replace_export_table,
)
from visitmap.sources import load_inputs

SF = "/root/testdata/sf0.001"
NTZ = T.TimestampNTZType()


def _rows(spark, day, n, tag):
    ts = datetime(day.year, day.month, day.day, 12)
    data = [(f"{tag}-{i}", ts, ts, ts, "app", "SMS", None, f"v{i}", ts, day) for i in range(n)]
    return spark.createDataFrame(data, output_schema(NTZ))


def _by_date(df):
    return {r.rpt_mst_date: r.n for r in df.groupBy("rpt_mst_date").agg(F.count("*").alias("n")).collect()}


def test_overwrite_touches_only_written_dates(spark):
    path = scratch_path(spark, "t-overwrite")
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    overwrite_partitions(_rows(spark, d1, 3, "a").unionByName(_rows(spark, d2, 4, "a")), path)
    overwrite_partitions(_rows(spark, d2, 2, "b"), path)
    back = spark.read.parquet(path)
    assert _by_date(back) == {d1: 3, d2: 2}
    assert {r.parent_contact_id[0] for r in back.where(F.col("rpt_mst_date") == d2).collect()} == {"b"}


def test_overlapping_report_day_reruns_equal_one_run(spark):
    cus, msg = load_inputs(spark, SF, "events")
    a = DateWindow("2024-01-03", "2024-01-12", "report_days")
    b = DateWindow("2024-01-08", "2024-01-20", "report_days")
    both = DateWindow("2024-01-03", "2024-01-20", "report_days")
    p_two, p_one = scratch_path(spark, "t-two"), scratch_path(spark, "t-one")
    run_window(cus, msg, a, p_two, build_ts="2024-02-01 00:00:00")
    run_window(cus, msg, b, p_two, build_ts="2024-02-01 00:00:00")
    run_window(cus, msg, both, p_one, build_ts="2024-02-01 00:00:00")
    two, one = spark.read.parquet(p_two), spark.read.parquet(p_one)
    assert two.count() == one.count() > 0
    assert two.exceptAll(one).count() == 0 and one.exceptAll(two).count() == 0
    assert set(_by_date(one)) == set(both.report_dates())


def test_closed_window_reruns_would_lose_rows(spark):
    """Why reruns use report days: a UTC-day window splits an MST day."""
    cus, msg = load_inputs(spark, SF, "events")
    path = scratch_path(spark, "t-closed")
    from visitmap.plans.visit_map import build_visit_map
    first = build_visit_map(cus, msg, DateWindow("2024-01-03", "2024-01-12", "whole_days"), build_ts="2024-02-01")
    overwrite_partitions(first, path)
    before = _by_date(spark.read.parquet(path))
    second = build_visit_map(cus, msg, DateWindow("2024-01-08", "2024-01-20", "whole_days"), build_ts="2024-02-01")
    overwrite_partitions(second, path)
    after = _by_date(spark.read.parquet(path))
    assert after[date(2024, 1, 7)] < before[date(2024, 1, 7)]


def test_rerun_of_same_window_changes_nothing(spark):
    cus, msg = load_inputs(spark, SF)
    w = DateWindow("1997-01-01", "1997-03-31", "report_days")
    path = scratch_path(spark, "t-same")
    run_window(cus, msg, w, path, build_ts="2024-02-01")
    first = spark.read.parquet(path).collect()
    run_window(cus, msg, w, path, build_ts="2024-02-01")
    assert sorted(spark.read.parquet(path).collect(), key=str) == sorted(first, key=str)


def test_orc_export_round_trip(spark):
    df = _rows(spark, date(2024, 1, 1), 3, "a")
    path = scratch_path(spark, "t-orc")
    export_orc(df.select(*reversed(OUTPUT_COLS)), path)
    export_orc(df.limit(1), path)                      # full refresh replaces everything
    back = spark.read.orc(path)
    assert back.columns == OUTPUT_COLS
    assert back.schema["rpt_mst_date"].dataType == T.StringType()
    assert [r.rpt_mst_date for r in back.collect()] == ["2024-01-01"]


def test_catalog_target_insert_by_name_is_dynamic(spark):
    table = f"t_{uuid.uuid4().hex}"
    create_target_table(spark, table, scratch_path(spark, "t-table"), time_type=NTZ)
    create_target_table(spark, table, scratch_path(spark, "t-table"), time_type=NTZ)   # IF NOT EXISTS
    assert spark.table(table).columns == OUTPUT_COLS
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    first = _rows(spark, d1, 3, "a").unionByName(_rows(spark, d2, 3, "a"))
    insert_overwrite_by_name(spark, first.select(*reversed(first.columns)), table)
    insert_overwrite_by_name(spark, _rows(spark, d2, 1, "b").select(*sorted(OUTPUT_COLS)), table)
    assert _by_date(spark.table(table)) == {d1: 3, d2: 1}


def test_export_table_full_refresh(spark):
    table = f"x_{uuid.uuid4().hex}"
    create_export_table(spark, table, scratch_path(spark, "t-export"), time_type=NTZ)
    assert spark.table(table).schema == export_schema(NTZ)
    replace_export_table(spark, _rows(spark, date(2024, 1, 1), 2, "a"), table)
    replace_export_table(spark, _rows(spark, date(2024, 1, 5), 1, "b"), table)
    assert [r.rpt_mst_date for r in spark.table(table).collect()] == ["2024-01-05"]


def test_path_sink_refuses_missing_and_extra_columns(spark):
    df = _rows(spark, date(2024, 1, 1), 1, "a")
    for wrong in (df.drop("visit_guid"), df.withColumn("more", F.lit(1)), df.drop("etl_build_mst_ts")):
        with pytest.raises(ValueError):
            overwrite_partitions(wrong, scratch_path(spark, "t-refused"))


def test_conform_by_name(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    assert conform(df, ["a", "b"]).columns == ["a", "b"]
    target = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    assert conform(df, target).schema["b"].dataType == T.LongType()
    with pytest.raises(ValueError):
        conform(df.withColumn("c", F.lit(1)), target)
    with pytest.raises(ValueError):
        conform(df, ["a", "c"])


def test_unsafe_location_refused(spark):
    with pytest.raises(ValueError):
        create_target_table(spark, "t_bad", "/tmp/x' OPTIONS ('a' 'b")


def test_read_target_keeps_date_without_inference(spark):
    from visitmap.sources import read_target

    path = scratch_path(spark, "t-read")
    overwrite_partitions(_rows(spark, date(2024, 1, 1), 2, "a"), path)
    old = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        back = read_target(spark, path, NTZ)
        assert back.columns == OUTPUT_COLS
        assert back.schema["rpt_mst_date"].dataType == T.DateType()
        plan = back.where(F.col("rpt_mst_date") == date(2024, 1, 1))._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(rpt_mst_date" in plan
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", old)


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    from visitmap.session import scratch_root

    root = scratch_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)
