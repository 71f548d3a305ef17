"""A conversation holding a third of the messaging rows (all distinct) is split, not left to one task."""

from datetime import datetime

from pyspark.sql import functions as F

from visitmap import build_visit_map

SKEW_CONF = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _inputs(spark, n):
    t = F.lit(datetime(2024, 1, 10, 12)).cast("timestamp_ntz")
    conv = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id").cast("string")))
    msg = spark.range(n).select(
        conv.alias("conversation_id"), (F.col("id") % 5).cast("int").alias("account_id"),
        F.lit("app").alias("visitor_app_id"), F.lit("SMS").alias("conversation_source"),
        F.concat(F.lit("d"), F.col("id").cast("string")).alias("visitor_device_type"),
        t.alias("conversation_end_utc_date"))
    cus = spark.range(n).where(F.col("id") % 3 != 0).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("conversation_id"),
        t.alias("conversation_start_utc_ts"), t.alias("conversation_end_utc_ts"),
        t.alias("conversation_end_utc_date"), F.array(F.lit("g")).alias("visit_guids"))
    hot = spark.range(1).select(F.lit("hot").alias("conversation_id"), t.alias("conversation_start_utc_ts"),
                                t.alias("conversation_end_utc_ts"), t.alias("conversation_end_utc_date"),
                                F.array(F.lit("g"), F.lit("h")).alias("visit_guids"))
    return cus.unionByName(hot), msg


def test_hot_conversation_is_split_by_aqe(spark):
    old = {k: spark.conf.get(k) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        n = 90000
        cus, msg = _inputs(spark, n)
        df = build_visit_map(cus, msg, None, build_ts="2024-02-01")
        rows = df.collect()
        # every messaging row is distinct; the hot one has two visit ids
        assert len(rows) == n // 3 * 2 + (n - n // 3)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_report_date_is_split_across_files(spark):
    """A report date holding most rows is written by several tasks, not one."""
    import os
    from datetime import date

    from pyspark.sql import types as T

    from visitmap.schemas import output_schema
    from visitmap.session import scratch_path
    from visitmap.sinks import overwrite_partitions

    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        t = F.lit(datetime(2024, 1, 10, 12)).cast("timestamp_ntz")
        hot = F.when(F.col("id") % 3 != 0, F.lit(date(2024, 1, 10))).otherwise(
            F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 9).cast("int")))
        df = spark.range(200000).select(
            F.concat(F.lit("k"), F.col("id").cast("string")).alias("parent_contact_id"),
            t.alias("conversation_start_utc_ts"), t.alias("conversation_end_utc_ts"),
            t.alias("conversation_end_utc_date"), F.lit("app").alias("app_id"),
            F.lit("SMS").alias("conversation_source"), F.lit(None).cast("string").alias("visitor_device_type"),
            F.col("id").cast("string").alias("visit_guid"), t.alias("etl_build_mst_ts"), hot.alias("rpt_mst_date"))
        assert df.columns == output_schema(T.TimestampNTZType()).names
        path = scratch_path(spark, "t-hot-date")
        overwrite_partitions(df, path)
        local = path.replace("file:", "")
        files = [f for f in os.listdir(os.path.join(local, "rpt_mst_date=2024-01-10")) if f.endswith(".parquet")]
        assert len(files) > 1
        assert spark.read.parquet(path).count() == 200000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
