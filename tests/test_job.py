import re
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest

from visitmap.job import parse_args, run
from visitmap.session import scratch_path
from visitmap.sources import load_inputs

SF = "/root/testdata/sf0.001"


def test_job_rolling_run_to_path_and_export(spark, tmp_path):
    cus, msg = load_inputs(spark, SF, "events")
    cus_path, msg_path = scratch_path(spark, "job-cus"), scratch_path(spark, "job-msg")
    cus.write.parquet(cus_path)
    msg.write.parquet(msg_path)
    target, export = scratch_path(spark, "job-target"), scratch_path(spark, "job-export")
    args = parse_args(["--customer", cus_path, "--messaging", msg_path, "--target-path", target,
                       "--export-path", export, "--as-of", "2024-01-15", "--build-ts", "2024-01-15 01:00:00"])
    window = run(spark, args)
    assert (window.start, window.end) == (date(2024, 1, 4), date(2024, 1, 14))
    out = spark.read.parquet(target)
    dates = {r.rpt_mst_date for r in out.select("rpt_mst_date").distinct().collect()}
    assert dates == set(window.report_dates())
    assert spark.read.orc(export).count() == out.count()


def test_job_to_catalog_table(spark):
    cus, msg = load_inputs(spark, SF)
    cus.createOrReplaceTempView("job_cus")
    msg.createOrReplaceTempView("job_msg")
    table = "job_target"
    args = parse_args(["--customer", "job_cus", "--messaging", "job_msg", "--target-table", table,
                       "--target-location", scratch_path(spark, "job-table"), "--backfill",
                       "--history-start", "1997-01-01", "--as-of", "1997-02-01", "--sides", "both"])
    run(spark, args)
    assert spark.table(table).count() > 0


def test_job_needs_one_target():
    with pytest.raises(SystemExit):
        parse_args(["--customer", "a", "--messaging", "b"])


def test_job_shuffle_width_flag(spark):
    args = parse_args(["--customer", "a", "--messaging", "b", "--target-path", "/x", "--shuffle-partitions", "4000"])
    assert args.shuffle_partitions == 4000


def test_job_restores_the_session_and_lets_explicit_settings_win(spark):
    from visitmap.job import settings
    from visitmap.session import RECOMMENDED_CONF, apply

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    args = parse_args(["--customer", "a", "--messaging", "b", "--target-path", "/x", "--conf", f"{key}=7m", "--shuffle-partitions", "9"])
    mine = settings(args)
    assert mine[key] == "7m" and mine["spark.sql.shuffle.partitions"] == "9"
    old = {k: spark.conf.get(k) for k in RECOMMENDED_CONF}
    with pytest.raises(ZeroDivisionError), apply(spark, {**RECOMMENDED_CONF, key: "7m"}):
        assert spark.conf.get(key) == "7m"
        raise ZeroDivisionError
    assert {k: spark.conf.get(k) for k in RECOMMENDED_CONF} == old
    for bad in (["--conf", "novalue"], ["--export-table", "t"]):
        with pytest.raises(SystemExit):
            parse_args(["--customer", "a", "--messaging", "b", "--target-path", "/x", *bad])


def test_job_with_plain_session_prunes_messaging(tmp_path):
    """main() in a process of its own and without any setting: its write is planned with the runtime filter."""
    script = Path(__file__).with_name("job_run.py")
    out = subprocess.run([sys.executable, str(script), SF, str(tmp_path)], capture_output=True, text=True, timeout=600)
    m = re.search(r"RESULT filter=(\w+) gate=(\S+) tasks=(\d+) scans=(\d+) rows=(\d+) exported=(\d+) left=(\S+)", out.stdout)
    assert m, out.stdout[-2000:] + out.stderr[-4000:]
    assert m[1] == "True"
    assert int(m[3]) <= 4           # partial filters to merge
    assert int(m[4]) == 1           # messaging is read once, with the export on
    assert int(m[5]) == int(m[6]) > 0
    assert m[2] == m[7]             # the session's own gate is back


def test_emptied_date_in_a_catalog_target(spark):
    from pyspark.sql import functions as F

    from visitmap.operators import add_report_date

    cus, msg = load_inputs(spark, SF, "events")
    table, where = "job_emptied", scratch_path(spark, "job-emptied")
    lost = add_report_date(cus).where(F.col("rpt_mst_date") != date(2024, 1, 10)).drop("rpt_mst_date")
    msg.createOrReplaceTempView("em_msg")
    for rows in (cus, lost):
        rows.createOrReplaceTempView("em_cus")
        run(spark, parse_args(["--customer", "em_cus", "--messaging", "em_msg", "--target-table", table, "--target-location", where,
                               "--as-of", "2024-01-15", "--build-ts", "2024-01-15 01:00:00"]))
    dates = {r[0] for r in spark.table(table).select("rpt_mst_date").distinct().collect()}
    assert date(2024, 1, 10) not in dates and date(2024, 1, 9) in dates
    spark.sql(f"DROP TABLE {table}")


def test_export_table_has_the_runs_rows(spark):
    cus, msg = load_inputs(spark, SF, "events")
    cus.createOrReplaceTempView("ex_cus")
    msg.createOrReplaceTempView("ex_msg")
    target = scratch_path(spark, "ex-target")
    run(spark, parse_args(["--customer", "ex_cus", "--messaging", "ex_msg", "--target-path", target, "--as-of", "2024-01-15",
                           "--export-table", "ex_table", "--export-location", scratch_path(spark, "ex-export")]))
    assert spark.table("ex_table").count() == spark.read.parquet(target).count() > 0
    spark.sql("DROP TABLE ex_table")


def test_closed_window_reads_midnight_dates_like_the_original(spark):
    rows = [(f"c{d}", f"2024-01-{d:02d}") for d in range(1, 21)]
    end = "cast(d as timestamp_ntz)"
    cus = spark.createDataFrame(rows, "conversation_id string, d string").selectExpr(
        "conversation_id", f"{end} as conversation_start_utc_ts", f"{end} as conversation_end_utc_ts", f"{end} as conversation_end_utc_date", "array('g') as visit_guids")
    msg = cus.selectExpr("conversation_id", "1 as account_id", "'a' as visitor_app_id", "'s' as conversation_source", "'d' as visitor_device_type", "conversation_end_utc_date")
    cus.createOrReplaceTempView("cl_cus")
    msg.createOrReplaceTempView("cl_msg")
    got = {}
    for mode in ("closed", "report_days"):
        path = scratch_path(spark, "closed")
        run(spark, parse_args(["--customer", "cl_cus", "--messaging", "cl_msg", "--target-path", path, "--as-of", "2024-01-15", "--window-mode", mode]))
        got[mode] = {r.parent_contact_id for r in spark.read.parquet(path).collect()}
    assert got["closed"] == {f"1-c{d}" for d in range(4, 15)}       # 04 .. 14, never the running day
    assert got["report_days"] == {f"1-c{d}" for d in range(5, 16)}  # midnight belongs to the report day before
