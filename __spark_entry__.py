"""

Every query reads the driver's tables (or a Spark projection of them, see
``visitmap.sources.fixtures``) whole. Windows are the job's own date windows,
not sampling. Arrays leave a query as text plus size, and every time value is
TIMESTAMP_NTZ or DATE, so results do not depend on the session time zone.
Queries q19-q22, q27, q29-q33, q35-q40 and q43-q45 write to fresh folders under the session's
checkpoint dir and return what they read back.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from visitmap import DateWindow, build_visit_map  # noqa: E402
from visitmap.functions.keys import contact_key  # noqa: E402
from visitmap.operators import (  # noqa: E402
    add_build_stamp,
    add_query_clock,
    add_report_date,
    dedupe,
    differences,
    distinct_sql,
    explode_ids,
    group_by_all_sql,
    link,
    link_on,
    overwrite_with_build_time,
    project_contract,
    rename_app_id,
)
from visitmap.job import parse_args as job_args  # noqa: E402
from visitmap.job import run as run_job  # noqa: E402
from visitmap.operators.dedupe import register_view  # noqa: E402
from visitmap.plans import scheduled_visit_map  # noqa: E402
from visitmap.plans.layout import append_layout, create_layout  # noqa: E402
from visitmap.plans.ledger import Ledger  # noqa: E402
from visitmap.plans.moves import Places  # noqa: E402
from visitmap.plans.rerun import backfill_run, run_window  # noqa: E402
from visitmap.plans.visit_map_sql import build_visit_map_sql  # noqa: E402
from visitmap.schemas import output_schema  # noqa: E402
from visitmap.session import scratch_path  # noqa: E402
from visitmap.sinks import (  # noqa: E402
    compact_dates,
    create_export_table,
    create_target_table,
    evolve_table,
    export_orc,
    insert_overwrite_by_name,
    overwrite_partitions,
    publish_export_table,
    read_evolved,
    replace_export_table,
)
from visitmap.sinks.compact import file_sizes  # noqa: E402
from visitmap.sinks.prints import DatePrints  # noqa: E402
from visitmap.sinks.tables import table_location  # noqa: E402
from visitmap.sources.rejects import Rejects  # noqa: E402
from visitmap.sources import load_inputs, read_table, read_target, scan_customer, scan_messaging  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed parameters of the checked queries.
WINDOW = DateWindow("1997-01-01", "1998-12-31")
BUILD_TS = "2024-02-01 12:34:56.789"
BUILD_TS_2 = "2024-02-02 08:00:00.000"
EVENTS_AS_OF = date(2024, 1, 15)
BACKFILL_AS_OF = date(2024, 1, 20)
RUN_A = DateWindow("1997-01-01", "1998-06-30", "report_days")
RUN_B = DateWindow("1998-01-01", "1998-12-31", "report_days")
EVENT_RUN_A = DateWindow("2024-01-03", "2024-01-12", "report_days")
EVENT_RUN_B = DateWindow("2024-01-08", "2024-01-20", "report_days")
MOVE_RUN_A = DateWindow("2023-11-25", "2024-01-05", "report_days")
MOVE_RUN_B = DateWindow("2023-12-31", "2024-01-31", "report_days")
HISTORY_RUN_START = date(2024, 1, 3)
SCHEDULED_AS_OF = date(1997, 6, 12)         # rolling window 1997-06-01 .. 1997-06-11


def _array_text(df: DataFrame, col: str = "visit_guids") -> DataFrame:
    """Replace an array column by ``<col>_text`` and ``<col>_size`` (NULL stays NULL)."""
    cols = []
    for c in df.columns:
        if c == col:
            cols.append(F.array_join(F.col(c), ",").alias(f"{c}_text"))
            cols.append(F.array_size(F.col(c)).cast("bigint").alias(f"{c}_size"))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def _inputs(spark: SparkSession, sf_dir: str, kind: str = "orders"):
    return load_inputs(spark, sf_dir, kind)


# ---- single operators ---------------------------------------------------------

def q01_scan_customer_window(spark, sf_dir):
    cus, _ = _inputs(spark, sf_dir)
    return _array_text(scan_customer(cus, WINDOW))


def q02_scan_messaging_window(spark, sf_dir):
    _, msg = _inputs(spark, sf_dir)
    return scan_messaging(msg, WINDOW)


def q03_rename_project(spark, sf_dir):
    _, msg = _inputs(spark, sf_dir)
    return rename_app_id(scan_messaging(msg)).select(
        "conversation_id", "account_id", "app_id", "conversation_source", "visitor_device_type")


def q04_join_using(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir)
    return _array_text(link(scan_customer(cus), scan_messaging(msg)))


def q05_join_on_both_keys(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir)
    return _array_text(link_on(scan_customer(cus), scan_messaging(msg)))


def q06_contact_key(spark, sf_dir):
    _, msg = _inputs(spark, sf_dir)
    m = scan_messaging(msg).withColumn(
        "account_id", F.when(F.col("account_id") != 0, F.col("account_id")))
    return m.select("conversation_id", "account_id",
                    contact_key(F.col("account_id"), F.col("conversation_id")).alias("parent_contact_id"))


def q07_drop_duplicates(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir)
    return _array_text(dedupe(link(scan_customer(cus), scan_messaging(msg))))


def q08_distinct_group_by(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir)
    return _array_text(distinct_sql(spark, link(scan_customer(cus), scan_messaging(msg))))


def q09_group_by_all(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir)
    exploded = explode_ids(link(scan_customer(cus), scan_messaging(msg)))
    return group_by_all_sql(spark, exploded)


def q10_explode_outer(spark, sf_dir):
    cus, _ = _inputs(spark, sf_dir)
    return explode_ids(scan_customer(cus)).select(
        "conversation_id", "conversation_end_utc_date", "visit_guid")


def q11_report_date_ts(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id", "ts")
    return add_report_date(events, source_col="ts")


def q12_report_date_string(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    text = orders.select("o_orderkey",
                         F.col("o_orderdate").cast("date").cast("string").alias("end_date_text"))
    return add_report_date(text, source_col="end_date_text")


def q13_build_stamp(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("conversation_end_utc_ts"))
    stamped = overwrite_with_build_time(orders, "conversation_end_utc_ts", BUILD_TS)
    return add_build_stamp(stamped, BUILD_TS)


def q14_rolling_window(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id", "ts")
    return DateWindow.rolling(EVENTS_AS_OF).apply(events, "ts")


def q15_backfill_window(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id", "ts")
    return DateWindow.backfill(BACKFILL_AS_OF).apply(events, "ts")


def q25_whole_day_window(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id", "ts")
    return DateWindow.rolling(EVENTS_AS_OF, mode="whole_days").apply(events, "ts")


def q26_report_day_window(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id", "ts")
    return add_report_date(DateWindow.rolling(EVENTS_AS_OF, mode="report_days").apply(events, "ts"), "ts")


def q28_query_time_clock(spark, sf_dir):
    """The clock read when the query runs, the same on every row; what it shows doesn't depend on the instant."""
    orders = add_query_clock(read_table(spark, sf_dir, "orders").select("o_orderkey"))
    past = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return orders.groupBy((F.col("o_orderkey") % 10).alias("key_group")).agg(
        F.count_distinct("query_ts").alias("stamps"), F.count("*").alias("rows"),
        F.sum(F.when(F.col("query_ts").isNull() | (F.col("query_ts") < past), 1).otherwise(0)).alias("wrong"))


# ---- whole job ------------------------------------------------------------------

def q16_final_projection(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir)
    return build_visit_map(cus, msg, None, build_ts=BUILD_TS)


def q17_visit_map_left_window(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir)
    return build_visit_map(cus, msg, WINDOW, sides="left", build_ts=BUILD_TS)


def q18_visit_map_both_windows(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir)
    return build_visit_map(cus, msg, WINDOW, sides="both", build_ts=BUILD_TS)


def q30_scheduled_window(spark, sf_dir):
    """The scheduled run's shape: 11-day rolling window on the customer side only, over its written slice."""
    cus, msg = _inputs(spark, sf_dir)
    return scheduled_visit_map(spark, cus, msg, DateWindow.rolling(SCHEDULED_AS_OF), build_ts=BUILD_TS)[0]


def q23_visit_map_sql_form(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir)
    return build_visit_map_sql(spark, cus, msg, WINDOW, build_ts=BUILD_TS)


def q24_distinct_sql_helper(spark, sf_dir):
    _, msg = _inputs(spark, sf_dir)
    return distinct_sql(spark, rename_app_id(scan_messaging(msg)))


# ---- sinks ------------------------------------------------------------------------

def _read_target(spark: SparkSession, path: str) -> DataFrame:
    return read_target(spark, path, T.TimestampNTZType())


def q19_partition_overwrite(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir)
    path = scratch_path(spark, "q19")
    run_window(cus, msg, RUN_A, path, build_ts=BUILD_TS)
    run_window(cus, msg, RUN_B, path, build_ts=BUILD_TS_2)
    return _read_target(spark, path)


def q20_overlapping_reruns(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir, "events")
    path = scratch_path(spark, "q20")
    run_window(cus, msg, EVENT_RUN_A, path, build_ts=BUILD_TS)
    run_window(cus, msg, EVENT_RUN_B, path, build_ts=BUILD_TS_2)
    return _read_target(spark, path)


def q21_orc_export(spark, sf_dir):
    path = scratch_path(spark, "q21")
    export_orc(q17_visit_map_left_window(spark, sf_dir), path)
    return spark.read.orc(path)


def q22_conform_by_name(spark, sf_dir):
    table = f"visitmap_target_{uuid.uuid4().hex}"
    path = scratch_path(spark, "q22")
    create_target_table(spark, table, path, time_type=T.TimestampNTZType())
    df = q17_visit_map_left_window(spark, sf_dir)
    shuffled = df.select(*reversed(df.columns))
    insert_overwrite_by_name(spark, shuffled, table)
    spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": table})  # external: the files stay
    return _read_target(spark, path)


def q27_scheduled_job(spark, sf_dir):
    """The command-line job: rolling report days as of a fixed day, inputs by name."""
    cus, msg = _inputs(spark, sf_dir, "events")
    path = scratch_path(spark, "q27")
    views = [register_view(cus), register_view(msg)]
    args = job_args(["--customer", views[0], "--messaging", views[1],
                     "--target-path", path, "--as-of", EVENTS_AS_OF.isoformat(), "--build-ts", BUILD_TS])
    run_job(spark, args)
    for v in views:
        spark.catalog.dropTempView(v)
    return _read_target(spark, path)


def q31_text_times_to_instants(spark, sf_dir):
    """Text times written into a TIMESTAMP target: the instants are UTC's, the stamp's is MST's."""
    text = F.col("o_orderdate").cast("timestamp_ntz").cast("string")
    rows = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("parent_contact_id"), text.alias("conversation_start_utc_ts"),
        text.alias("conversation_end_utc_ts"), text.alias("conversation_end_utc_date"), F.lit("a").alias("app_id"),
        F.lit("s").alias("conversation_source"), F.lit("d").alias("visitor_device_type"), F.lit("g").alias("visit_guid"))
    path = scratch_path(spark, "q31")
    overwrite_partitions(project_contract(add_build_stamp(add_report_date(rows), "2024-02-01 12:34:56")), path)
    return read_target(spark, path).select(
        F.col("parent_contact_id").cast("bigint").alias("o_orderkey"), F.unix_seconds("conversation_end_utc_date").alias("end_epoch"),
        F.unix_seconds("etl_build_mst_ts").alias("stamp_epoch"), "rpt_mst_date")


def q32_rerun_empties_a_date(spark, sf_dir):
    """A second run over an input that has lost a report date leaves that date empty."""
    cus, msg = _inputs(spark, sf_dir, "events")
    path = scratch_path(spark, "q32")
    run_window(cus, msg, EVENT_RUN_A, path, build_ts=BUILD_TS)
    lost = add_report_date(cus).where(F.col("rpt_mst_date") != date(2024, 1, 10)).drop("rpt_mst_date")
    run_window(lost, msg, EVENT_RUN_B, path, build_ts=BUILD_TS_2)
    return _read_target(spark, path)


def q33_closed_window_job(spark, sf_dir):
    """The job on midnight-valued end dates, with the original's closed bounds."""
    cus, msg = _inputs(spark, sf_dir)
    path = scratch_path(spark, "q33")
    views = [register_view(cus), register_view(msg)]
    run_job(spark, job_args(["--customer", views[0], "--messaging", views[1], "--target-path", path, "--window-mode", "closed",
                             "--as-of", SCHEDULED_AS_OF.isoformat(), "--build-ts", BUILD_TS]))
    for v in views:
        spark.catalog.dropTempView(v)
    return _read_target(spark, path)


def q34_zoned_text(spark, sf_dir):
    """The report date of text that names its own zone."""
    text = F.col("ts").cast("timestamp_ntz").cast("string")
    zone = F.when(F.col("event_id") % 3 == 0, "+09:00").when(F.col("event_id") % 3 == 1, "-03:30").otherwise("Z")
    rows = read_table(spark, sf_dir, "events").select("event_id", F.concat(text, zone).alias("t"))
    return add_report_date(rows, "t").select("event_id", "rpt_mst_date")


def q29_export_table(spark, sf_dir):
    """The ORC export as a catalog table: dropped, defined, refreshed by name."""
    table = f"visitmap_export_{uuid.uuid4().hex}"
    path = scratch_path(spark, "q29")
    create_export_table(spark, table, path, time_type=T.TimestampNTZType())
    replace_export_table(spark, q17_visit_map_left_window(spark, sf_dir), table)
    schema = spark.table(table).schema
    spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": table})
    return spark.read.schema(schema).orc(path)


def _shifted(cus: DataFrame, moved: F.Column) -> DataFrame:
    """``cus`` with its times 30 days earlier where ``moved``."""
    times = ("conversation_start_utc_ts", "conversation_end_utc_ts", "conversation_end_utc_date")
    return cus.withColumns({c: F.when(moved, F.col(c) - F.expr("INTERVAL 30 DAYS")).otherwise(F.col(c)) for c in times})


def q35_moved_conversations(spark, sf_dir):
    """Conversations that end 30 days later in the second run's input are in the target once, on their new date."""
    cus, msg = _inputs(spark, sf_dir, "events")
    key = F.col("conversation_id").cast("bigint") % 50
    path, places = scratch_path(spark, "q35"), Places(scratch_path(spark, "q35-places"))
    run_window(_shifted(cus, key.isin(0, 1)), msg, MOVE_RUN_A, path, build_ts=BUILD_TS, places=places)
    run_window(_shifted(cus, key == 1), msg, MOVE_RUN_B, path, build_ts=BUILD_TS_2, places=places)
    return _read_target(spark, path)


def _bad_times(cus: DataFrame) -> DataFrame:
    """``cus`` with times as text, some of which mean no time."""
    key = F.col("conversation_id").cast("bigint")
    text = {c: F.col(c).cast("timestamp_ntz").cast("string") for c in ("conversation_start_utc_ts", "conversation_end_utc_ts", "conversation_end_utc_date")}
    text["conversation_end_utc_date"] = F.when(key % 40 == 7, F.lit("n/a")).otherwise(text["conversation_end_utc_date"])
    text["conversation_start_utc_ts"] = F.when(key % 60 == 11, F.lit("2024-13-45")).otherwise(text["conversation_start_utc_ts"])
    return cus.withColumns(text)


def _run_with_bad_times(spark, sf_dir):
    cus, msg = _inputs(spark, sf_dir, "events")
    path, rejects = scratch_path(spark, "bad-times"), Rejects(scratch_path(spark, "rejects"))
    run_window(_bad_times(cus), msg, EVENT_RUN_A, path, build_ts=BUILD_TS, rejects=rejects)
    return path, rejects


def q36_bad_times_good_rows(spark, sf_dir):
    """Rows with a time that means none don't stop the run; all others are written."""
    return _read_target(spark, _run_with_bad_times(spark, sf_dir)[0])


def q37_bad_times_rejects(spark, sf_dir):
    """The reject table: each bad value of the run, and the counts that the run observed on the way."""
    _, rejects = _run_with_bad_times(spark, sf_dir)
    seen = rejects.counts["customer"]
    return rejects.read(spark).select("source", "conversation_id", "column", "value", "run_date", F.lit(seen["good"]).cast("bigint").alias("good_rows"),
                                      F.lit(seen["bad"]).cast("bigint").alias("bad_rows"))


def q38_export_without_gap(spark, sf_dir):
    """A write that fails leaves the export as it was; the next one replaces it at once."""
    table, path = f"visitmap_export_{uuid.uuid4().hex}", scratch_path(spark, "q38")
    rows = q17_visit_map_left_window(spark, sf_dir)
    publish_export_table(spark, rows.limit(0), table, path)
    publish_export_table(spark, rows, table, path)
    try:
        publish_export_table(spark, rows.withColumn("visit_guid", F.raise_error(F.lit("a failing write"))), table, path)
    except Exception as error:  # noqa: BLE001
        if "a failing write" not in str(error):
            raise
    schema, location = spark.table(table).schema, table_location(spark, table)
    spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": table})
    return spark.read.schema(schema).orc(location)


def q39_only_changed_dates(spark, sf_dir):
    """A rerun writes only the dates whose rows have changed: all others keep the first run's stamp."""
    cus, msg = _inputs(spark, sf_dir, "events")
    path, prints = scratch_path(spark, "q39"), DatePrints(scratch_path(spark, "q39-prints"))
    run_window(cus, msg, EVENT_RUN_A, path, build_ts=BUILD_TS, prints=prints)
    dated = add_report_date(cus)
    fewer = dated.where((F.col("rpt_mst_date") != date(2024, 1, 10)) | (F.col("conversation_id").cast("bigint") % 2 == 1)).drop("rpt_mst_date")
    run_window(fewer, msg, EVENT_RUN_A, path, build_ts=BUILD_TS_2, prints=prints)
    return _read_target(spark, path)


def q40_resumed_backfill(spark, sf_dir):
    """A history run that was cut off after its first slices goes on where it stopped: those keep their stamp."""
    cus, msg = _inputs(spark, sf_dir, "events")
    path, ledger = scratch_path(spark, "q40"), Ledger(scratch_path(spark, "q40-ledger"))
    window = DateWindow.backfill(BACKFILL_AS_OF, HISTORY_RUN_START, mode="report_days")
    for part in ledger.open_slices(spark, window, 5)[:2]:
        run_window(cus, msg, part, path, build_ts=BUILD_TS)
        ledger.done(spark, window, part)
    backfill_run(cus, msg, path, as_of=BACKFILL_AS_OF, start=HISTORY_RUN_START, ledger=ledger, slice_days=5, build_ts=BUILD_TS_2)
    return _read_target(spark, path)


def q41_zoned_text_window(spark, sf_dir):
    """Report-day windows and report dates agree on text that names its own zone."""
    text = F.col("ts").cast("timestamp_ntz").cast("string")
    zone = F.when(F.col("event_id") % 3 == 0, "+09:00").when(F.col("event_id") % 3 == 1, "-03:30").otherwise("Z")
    rows = read_table(spark, sf_dir, "events").select("event_id", F.concat(text, zone).alias("t"))
    return add_report_date(EVENT_RUN_A.apply(rows, "t"), "t").select("event_id", "rpt_mst_date")


def q42_table_differences(spark, sf_dir):
    """Rows that two versions of a table don't have equally often."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    key = F.col("o_orderkey")
    rows = read_table(spark, sf_dir, "orders").select("o_orderkey", *[F.col(c) for c in ("o_custkey", "o_orderstatus")], F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    other = rows.where(key % 97 != 3).withColumn("o_orderstatus", F.when(key % 89 == 5, F.lit(None)).otherwise(F.col("o_orderstatus")))
    again = rows.where(key % 101 == 7)
    return differences(orders, other.unionAll(again).drop("o_orderkey"))


def q43_compacted_dates(spark, sf_dir):
    """Dates written in many small files, then compacted: the same rows, and how many files each row's date has."""
    cus, msg = _inputs(spark, sf_dir, "events")
    path = scratch_path(spark, "q43")
    rows = build_visit_map(cus, msg, EVENT_RUN_A, build_ts=BUILD_TS)
    overwrite_partitions(rows.repartition(8, "visit_guid"), path, rebalance=False)
    compact_dates(spark, path, at_least=2)
    files = file_sizes(spark, path).groupBy("rpt_mst_date").agg(F.count("*").alias("files"))
    return _read_target(spark, path).join(files, "rpt_mst_date")


def q44_grown_contract(spark, sf_dir):
    """A target whose contract gets a column, then a wider type and one more: old and new dates read together."""
    def contract(*more):
        *fields, day = output_schema(T.TimestampNTZType()).fields
        return T.StructType([*fields, *more, day])

    table, path = f"visitmap_target_{uuid.uuid4().hex}", scratch_path(spark, "q44")
    create_target_table(spark, table, path, time_type=T.TimestampNTZType())
    rows = q17_visit_map_left_window(spark, sf_dir).withColumn("guid_chars", F.length("visit_guid"))
    evolve_table(spark, table, contract(T.StructField("guid_chars", T.IntegerType())))
    insert_overwrite_by_name(spark, rows.where(F.col("rpt_mst_date") < date(1998, 1, 1)), table)
    latest = contract(T.StructField("guid_chars", T.LongType()), T.StructField("has_app", T.BooleanType()))
    evolve_table(spark, table, latest)
    insert_overwrite_by_name(spark, rows.where(F.col("rpt_mst_date") >= date(1998, 1, 1)).withColumn("has_app", F.col("app_id").isNotNull()), table)
    spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": table})  # external: the files stay
    return read_evolved(spark, path, latest)


def q45_laid_out_messaging(spark, sf_dir):
    """The command-line job over messaging laid out by conversation in two steps, some rows twice, conversations of 7 lines apart."""
    cus, msg = _inputs(spark, sf_dir)
    path, name, view = scratch_path(spark, "q45"), f"visitmap_messaging_{uuid.uuid4().hex}", register_view(cus)
    shipped = F.col("conversation_end_utc_date")
    layout = create_layout(spark, msg.where(shipped < date(1997, 7, 1)), name, scratch_path(spark, "q45-layout"), buckets=8, hot_rows=6)
    append_layout(spark, layout, msg.where((shipped >= date(1997, 6, 1)) | shipped.isNull()), hot_rows=6)
    run_job(spark, job_args(["--customer", view, "--messaging-layout", name, "--target-path", path, "--window-mode", "closed",
                             "--as-of", SCHEDULED_AS_OF.isoformat(), "--build-ts", BUILD_TS]))
    spark.catalog.dropTempView(view)
    for table in (layout.name, layout.hot_name):
        spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": table})  # external: the files stay
    return _read_target(spark, path)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        q01_scan_customer_window, q02_scan_messaging_window, q03_rename_project, q04_join_using,
        q05_join_on_both_keys, q06_contact_key, q07_drop_duplicates, q08_distinct_group_by,
        q09_group_by_all, q10_explode_outer, q11_report_date_ts, q12_report_date_string,
        q13_build_stamp, q14_rolling_window, q15_backfill_window, q16_final_projection,
        q17_visit_map_left_window, q18_visit_map_both_windows, q19_partition_overwrite,
        q20_overlapping_reruns, q21_orc_export, q22_conform_by_name, q23_visit_map_sql_form,
        q24_distinct_sql_helper, q25_whole_day_window, q26_report_day_window, q27_scheduled_job,
        q28_query_time_clock, q29_export_table, q30_scheduled_window, q31_text_times_to_instants,
        q32_rerun_empties_a_date, q33_closed_window_job, q34_zoned_text,
        q35_moved_conversations, q36_bad_times_good_rows, q37_bad_times_rejects, q38_export_without_gap,
        q39_only_changed_dates, q40_resumed_backfill, q41_zoned_text_window, q42_table_differences,
        q43_compacted_dates, q44_grown_contract, q45_laid_out_messaging,
    )
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query (the scheduled job: customer-side window) on sf0.001."""
    return q17_visit_map_left_window(spark, SMOKE_DIR)


# The corpus operators are an optional subpackage; without it the job's own queries remain.
try:
    from visitmap.llm.queries import ORACLES as _CORPUS_ORACLES
    from visitmap.llm.queries import QUERIES as _CORPUS_QUERIES
except ModuleNotFoundError as error:
    if not (error.name or "").startswith("visitmap.llm"):
        raise
    _CORPUS_QUERIES, _CORPUS_ORACLES = {}, {}

try:
    import corpus_pipeline as _corpus_pipeline
except ModuleNotFoundError as error:
    if error.name != "corpus_pipeline" and not (error.name or "").startswith("visitmap.llm"):
        raise
    _corpus_pipeline = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {**_QUERIES, **_CORPUS_QUERIES}
    if _corpus_pipeline is not None:
        found["pipeline"] = _corpus_pipeline.run
    return found


# ---- DuckDB oracles ---------------------------------------------------------------
# The same fixture mapping and job, written independently as plain SQL.

_CUS_ORDERS = """
cus AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS conversation_id,
         o_orderdate AS conversation_start_utc_ts,
         o_orderdate AS conversation_end_utc_ts,
         o_orderdate AS conversation_end_utc_date,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL::VARCHAR[]
              WHEN o_orderkey % 11 = 0 THEN []::VARCHAR[]
              ELSE ['v' || CAST(o_custkey % 13 AS VARCHAR), 'v' || CAST(o_orderkey % 17 AS VARCHAR)]
         END AS visit_guids
  FROM orders)"""

_MSG_LINEITEM = """
msg AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS conversation_id,
         l_suppkey % 5 AS account_id,
         l_returnflag AS visitor_app_id,
         l_linestatus AS conversation_source,
         CASE WHEN l_quantity > 25 THEN 'Desktop' END AS visitor_device_type,
         l_shipdate AS conversation_end_utc_date
  FROM lineitem)"""

_CUS_EVENTS = """
cus AS (
  SELECT CAST(event_id AS VARCHAR) AS conversation_id,
         ts AS conversation_start_utc_ts,
         ts AS conversation_end_utc_ts,
         ts AS conversation_end_utc_date,
         CASE WHEN event_type = 'error' THEN NULL::VARCHAR[]
              ELSE [event_type, 'u' || CAST(user_id % 3 AS VARCHAR)] END AS visit_guids
  FROM events)"""

_MSG_EVENTS = """
msg AS (
  SELECT CAST(event_id AS VARCHAR) AS conversation_id,
         user_id % 5 AS account_id,
         event_type AS visitor_app_id,
         'web' AS conversation_source,
         CASE WHEN value > 25 THEN 'Desktop' END AS visitor_device_type,
         ts AS conversation_end_utc_date
  FROM events)"""

_ORDERS_FIXTURE = "WITH " + _CUS_ORDERS + "," + _MSG_LINEITEM
_EVENTS_FIXTURE = "WITH " + _CUS_EVENTS + "," + _MSG_EVENTS

_IN_WINDOW_CUS = ("c.conversation_end_utc_date >= TIMESTAMP '1997-01-01 00:00:00' "
                  "AND c.conversation_end_utc_date <= TIMESTAMP '1998-12-31 00:00:00'")
_IN_WINDOW_MSG = _IN_WINDOW_CUS.replace("c.", "m.")

_LINKED_SELECT = """
  SELECT CAST(m.account_id AS VARCHAR) || '-' || c.conversation_id AS parent_contact_id,
         c.conversation_start_utc_ts, c.conversation_end_utc_ts, c.conversation_end_utc_date,
         c.visit_guids, m.visitor_app_id AS app_id, m.visitor_device_type, m.conversation_source
  FROM cus c JOIN msg m ON c.conversation_id = m.conversation_id"""

_LINKED_TEXT_COLS = """parent_contact_id, conversation_start_utc_ts, conversation_end_utc_ts,
       conversation_end_utc_date, array_to_string(visit_guids, ',') AS visit_guids_text,
       len(visit_guids) AS visit_guids_size, app_id, visitor_device_type, conversation_source"""


def _visit_map_sql(fixture: str, where: str, stamp_sql: str) -> str:
    """The whole job: join, explode (NULL/empty -> one NULL id), distinct, date, stamp."""
    return f"""{fixture},
linked AS ({_LINKED_SELECT}
  WHERE {where}),
exploded AS (
  SELECT DISTINCT parent_contact_id, conversation_start_utc_ts, conversation_end_utc_ts,
         conversation_end_utc_date, app_id, conversation_source, visitor_device_type,
         UNNEST(CASE WHEN visit_guids IS NULL OR len(visit_guids) = 0 THEN [NULL::VARCHAR]
                     ELSE visit_guids END) AS visit_guid
  FROM linked),
dated AS (
  SELECT *, CAST(conversation_end_utc_date - INTERVAL 7 HOUR AS DATE) AS rpt_mst_date FROM exploded)
SELECT parent_contact_id, conversation_start_utc_ts, conversation_end_utc_ts, conversation_end_utc_date,
       app_id, conversation_source, visitor_device_type, visit_guid,
       {stamp_sql} AS etl_build_mst_ts, rpt_mst_date
FROM dated"""


_STAMP = f"TIMESTAMP '{BUILD_TS}'"
_STAMP_2 = f"TIMESTAMP '{BUILD_TS_2}'"


_IN_EVENT_RUN_A = """c.conversation_end_utc_date >= TIMESTAMP '2024-01-03 07:00:00'
        AND c.conversation_end_utc_date < TIMESTAMP '2024-01-13 07:00:00'"""


def _two_runs_stamp(second_run_start: str) -> str:
    return f"CASE WHEN rpt_mst_date < DATE '{second_run_start}' THEN {_STAMP} ELSE {_STAMP_2} END"


_ORACLES = {
    "q01_scan_customer_window": f"""{_ORDERS_FIXTURE}
SELECT conversation_id, conversation_start_utc_ts, conversation_end_utc_ts, conversation_end_utc_date,
       array_to_string(visit_guids, ',') AS visit_guids_text, len(visit_guids) AS visit_guids_size
FROM cus c WHERE {_IN_WINDOW_CUS}""",
    "q02_scan_messaging_window": f"""{_ORDERS_FIXTURE}
SELECT conversation_id, account_id, visitor_app_id, conversation_source, visitor_device_type
FROM msg m WHERE {_IN_WINDOW_MSG}""",
    "q03_rename_project": f"""{_ORDERS_FIXTURE}
SELECT conversation_id, account_id, visitor_app_id AS app_id, conversation_source, visitor_device_type
FROM msg""",
    "q04_join_using": f"""{_ORDERS_FIXTURE}, linked AS ({_LINKED_SELECT})
SELECT {_LINKED_TEXT_COLS} FROM linked""",
    "q05_join_on_both_keys": f"""{_ORDERS_FIXTURE}
SELECT c.conversation_id AS cus_conversation_id, m.conversation_id AS msg_conversation_id,
       CAST(m.account_id AS VARCHAR) || '-' || c.conversation_id AS parent_contact_id,
       c.conversation_start_utc_ts, c.conversation_end_utc_ts, c.conversation_end_utc_date,
       array_to_string(c.visit_guids, ',') AS visit_guids_text, len(c.visit_guids) AS visit_guids_size,
       m.visitor_app_id AS app_id, m.visitor_device_type, m.conversation_source
FROM cus c JOIN msg m ON c.conversation_id = m.conversation_id""",
    "q06_contact_key": f"""{_ORDERS_FIXTURE}, m AS (
  SELECT conversation_id, CASE WHEN account_id <> 0 THEN account_id END AS account_id FROM msg)
SELECT conversation_id, account_id, CAST(account_id AS VARCHAR) || '-' || conversation_id AS parent_contact_id
FROM m""",
    "q07_drop_duplicates": f"""{_ORDERS_FIXTURE}, linked AS (SELECT DISTINCT * FROM ({_LINKED_SELECT}))
SELECT {_LINKED_TEXT_COLS} FROM linked""",
    "q08_distinct_group_by": f"""{_ORDERS_FIXTURE}, linked AS (SELECT DISTINCT * FROM ({_LINKED_SELECT}))
SELECT {_LINKED_TEXT_COLS} FROM linked""",
    "q09_group_by_all": f"""{_ORDERS_FIXTURE}, linked AS ({_LINKED_SELECT})
SELECT DISTINCT parent_contact_id, conversation_start_utc_ts, conversation_end_utc_ts, conversation_end_utc_date,
       UNNEST(CASE WHEN visit_guids IS NULL OR len(visit_guids) = 0 THEN [NULL::VARCHAR]
                   ELSE visit_guids END) AS visit_guid,
       app_id, visitor_device_type, conversation_source
FROM linked""",
    "q10_explode_outer": f"""{_ORDERS_FIXTURE}
SELECT conversation_id, conversation_end_utc_date,
       UNNEST(CASE WHEN visit_guids IS NULL OR len(visit_guids) = 0 THEN [NULL::VARCHAR]
                   ELSE visit_guids END) AS visit_guid
FROM cus""",
    "q11_report_date_ts": """
SELECT event_id, ts, CAST(ts - INTERVAL 7 HOUR AS DATE) AS rpt_mst_date FROM events""",
    "q12_report_date_string": """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS end_date_text,
       CAST(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) - INTERVAL 7 HOUR AS DATE) AS rpt_mst_date
FROM orders""",
    "q13_build_stamp": f"""
SELECT o_orderkey, {_STAMP} AS conversation_end_utc_ts, {_STAMP} AS etl_build_mst_ts FROM orders""",
    "q14_rolling_window": """
SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-04 00:00:00' AND ts <= TIMESTAMP '2024-01-14 00:00:00'""",
    "q15_backfill_window": """
SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2016-01-01 00:00:00' AND ts <= TIMESTAMP '2024-01-19 00:00:00'""",
    "q16_final_projection": _visit_map_sql(_ORDERS_FIXTURE, "TRUE", _STAMP),
    "q17_visit_map_left_window": _visit_map_sql(_ORDERS_FIXTURE, _IN_WINDOW_CUS, _STAMP),
    "q18_visit_map_both_windows": _visit_map_sql(
        _ORDERS_FIXTURE, f"{_IN_WINDOW_CUS} AND {_IN_WINDOW_MSG}", _STAMP),
    "q19_partition_overwrite": _visit_map_sql(
        _ORDERS_FIXTURE,
        "c.conversation_end_utc_date >= TIMESTAMP '1997-01-01 07:00:00' "
        "AND c.conversation_end_utc_date < TIMESTAMP '1999-01-01 07:00:00'",
        _two_runs_stamp("1998-01-01")),
    "q20_overlapping_reruns": _visit_map_sql(
        _EVENTS_FIXTURE,
        "c.conversation_end_utc_date >= TIMESTAMP '2024-01-03 07:00:00' "
        "AND c.conversation_end_utc_date < TIMESTAMP '2024-01-21 07:00:00'",
        _two_runs_stamp("2024-01-08")),
    "q21_orc_export": f"""SELECT * REPLACE (CAST(rpt_mst_date AS VARCHAR) AS rpt_mst_date) FROM (
{_visit_map_sql(_ORDERS_FIXTURE, _IN_WINDOW_CUS, _STAMP)})""",
    "q22_conform_by_name": _visit_map_sql(_ORDERS_FIXTURE, _IN_WINDOW_CUS, _STAMP),
    "q23_visit_map_sql_form": _visit_map_sql(_ORDERS_FIXTURE, _IN_WINDOW_CUS, _STAMP),
    "q25_whole_day_window": """
SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-04 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'""",
    "q26_report_day_window": """
SELECT event_id, ts, CAST(ts - INTERVAL 7 HOUR AS DATE) AS rpt_mst_date FROM events
WHERE ts >= TIMESTAMP '2024-01-04 07:00:00' AND ts < TIMESTAMP '2024-01-15 07:00:00'""",
    "q27_scheduled_job": _visit_map_sql(
        _EVENTS_FIXTURE,
        "c.conversation_end_utc_date >= TIMESTAMP '2024-01-04 07:00:00' "
        "AND c.conversation_end_utc_date < TIMESTAMP '2024-01-15 07:00:00'",
        _STAMP),
    "q29_export_table": f"""SELECT * REPLACE (CAST(rpt_mst_date AS VARCHAR) AS rpt_mst_date) FROM (
{_visit_map_sql(_ORDERS_FIXTURE, _IN_WINDOW_CUS, _STAMP)})""",
    "q30_scheduled_window": _visit_map_sql(
        _ORDERS_FIXTURE,
        "c.conversation_end_utc_date >= TIMESTAMP '1997-06-01 00:00:00' "
        "AND c.conversation_end_utc_date <= TIMESTAMP '1997-06-11 00:00:00'",
        _STAMP),
    "q28_query_time_clock": """
SELECT o_orderkey % 10 AS key_group, 1::BIGINT AS stamps, count(*) AS rows, 0::BIGINT AS wrong FROM orders GROUP BY 1""",
    "q31_text_times_to_instants": """
SELECT o_orderkey, CAST(epoch(CAST(o_orderdate AS TIMESTAMP)) AS BIGINT) AS end_epoch,
       CAST(epoch(TIMESTAMP '2024-02-01 19:34:56') AS BIGINT) AS stamp_epoch,
       CAST(CAST(o_orderdate AS TIMESTAMP) - INTERVAL 7 HOUR AS DATE) AS rpt_mst_date
FROM orders""",
    "q32_rerun_empties_a_date": f"""SELECT * FROM (
{_visit_map_sql(_EVENTS_FIXTURE, """c.conversation_end_utc_date >= TIMESTAMP '2024-01-03 07:00:00'
        AND c.conversation_end_utc_date < TIMESTAMP '2024-01-21 07:00:00'""", _two_runs_stamp("2024-01-08"))})
WHERE rpt_mst_date <> DATE '2024-01-10'""",
    "q33_closed_window_job": _visit_map_sql(
        _ORDERS_FIXTURE,
        "c.conversation_end_utc_date >= TIMESTAMP '1997-06-01 00:00:00' "
        "AND c.conversation_end_utc_date <= TIMESTAMP '1997-06-11 00:00:00'",
        _STAMP),
    "q34_zoned_text": """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(CAST(ts AS TIMESTAMP) - INTERVAL 9 HOUR - INTERVAL 7 HOUR AS DATE)
                                   WHEN 1 THEN CAST(CAST(ts AS TIMESTAMP) + INTERVAL 3 HOUR + INTERVAL 30 MINUTE - INTERVAL 7 HOUR AS DATE)
                                   ELSE CAST(CAST(ts AS TIMESTAMP) - INTERVAL 7 HOUR AS DATE) END AS rpt_mst_date
FROM events""",
    "q35_moved_conversations": _visit_map_sql(
        _EVENTS_FIXTURE.replace("  FROM events),", "  FROM (SELECT * REPLACE (CASE WHEN event_id % 50 = 1 THEN ts - INTERVAL 30 DAY ELSE ts END AS ts) FROM events)),", 1),
        "TRUE", _two_runs_stamp("2023-12-31")),
    "q36_bad_times_good_rows": _visit_map_sql(_EVENTS_FIXTURE, _IN_EVENT_RUN_A + """
        AND CAST(c.conversation_id AS BIGINT) % 40 <> 7 AND CAST(c.conversation_id AS BIGINT) % 60 <> 11""", _STAMP),
    "q37_bad_times_rejects": f"""WITH seen AS (
  SELECT CAST(event_id AS VARCHAR) AS conversation_id, event_id % 40 = 7 AS bad_end,
         event_id % 60 = 11 AND (event_id % 40 = 7 OR {_IN_EVENT_RUN_A.replace("c.conversation_end_utc_date", "ts")}) AS bad_start,
         event_id % 40 = 7 OR {_IN_EVENT_RUN_A.replace("c.conversation_end_utc_date", "ts")} AS read
  FROM events),
counted AS (
  SELECT count(*) FILTER (WHERE read AND NOT bad_end AND NOT bad_start)::BIGINT AS good_rows,
         count(*) FILTER (WHERE bad_end OR bad_start)::BIGINT AS bad_rows FROM seen)
SELECT 'customer' AS source, conversation_id, 'conversation_end_utc_date' AS "column", 'n/a' AS value, DATE '2024-01-12' AS run_date, good_rows, bad_rows
FROM seen, counted WHERE bad_end
UNION ALL
SELECT 'customer', conversation_id, 'conversation_start_utc_ts', '2024-13-45', DATE '2024-01-12', good_rows, bad_rows FROM seen, counted WHERE bad_start""",
    "q38_export_without_gap": f"""SELECT * REPLACE (CAST(rpt_mst_date AS VARCHAR) AS rpt_mst_date) FROM (
{_visit_map_sql(_ORDERS_FIXTURE, _IN_WINDOW_CUS, _STAMP)})""",
    "q39_only_changed_dates": _visit_map_sql(_EVENTS_FIXTURE, _IN_EVENT_RUN_A + """
        AND (CAST(c.conversation_end_utc_date - INTERVAL 7 HOUR AS DATE) <> DATE '2024-01-10' OR CAST(c.conversation_id AS BIGINT) % 2 = 1)""",
        f"CASE WHEN rpt_mst_date = DATE '2024-01-10' THEN {_STAMP_2} ELSE {_STAMP} END"),
    "q40_resumed_backfill": _visit_map_sql(
        _EVENTS_FIXTURE, "c.conversation_end_utc_date >= TIMESTAMP '2024-01-03 07:00:00' AND c.conversation_end_utc_date < TIMESTAMP '2024-01-20 07:00:00'",
        _two_runs_stamp("2024-01-13")),
    "q41_zoned_text_window": """SELECT * FROM (
SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(CAST(ts AS TIMESTAMP) - INTERVAL 9 HOUR - INTERVAL 7 HOUR AS DATE)
                                   WHEN 1 THEN CAST(CAST(ts AS TIMESTAMP) + INTERVAL 3 HOUR + INTERVAL 30 MINUTE - INTERVAL 7 HOUR AS DATE)
                                   ELSE CAST(CAST(ts AS TIMESTAMP) - INTERVAL 7 HOUR AS DATE) END AS rpt_mst_date
FROM events) WHERE rpt_mst_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-12'""",
    "q42_table_differences": """
WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders),
b AS (SELECT o_custkey, CASE WHEN o_orderkey % 89 = 5 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM a WHERE o_orderkey % 97 <> 3
      UNION ALL SELECT o_custkey, o_orderstatus, o_totalprice FROM a WHERE o_orderkey % 101 = 7),
n AS (SELECT o_custkey, o_orderstatus, o_totalprice, sum(l)::BIGINT AS n_left, sum(r)::BIGINT AS n_right
      FROM (SELECT o_custkey, o_orderstatus, o_totalprice, 1 AS l, 0 AS r FROM a UNION ALL SELECT *, 0, 1 FROM b) GROUP BY ALL)
SELECT * FROM n WHERE n_left <> n_right""",
    "q43_compacted_dates": f"""SELECT *, 1::BIGINT AS files FROM (
{_visit_map_sql(_EVENTS_FIXTURE, _IN_EVENT_RUN_A, _STAMP)})""",
    "q44_grown_contract": f"""SELECT *, CAST(length(visit_guid) AS BIGINT) AS guid_chars,
       CASE WHEN rpt_mst_date >= DATE '1998-01-01' THEN app_id IS NOT NULL END AS has_app FROM (
{_visit_map_sql(_ORDERS_FIXTURE, _IN_WINDOW_CUS, _STAMP)})""",
    "q45_laid_out_messaging": _visit_map_sql(
        _ORDERS_FIXTURE,
        "c.conversation_end_utc_date >= TIMESTAMP '1997-06-01 00:00:00' "
        "AND c.conversation_end_utc_date <= TIMESTAMP '1997-06-11 00:00:00'",
        _STAMP),
    "q24_distinct_sql_helper": f"""{_ORDERS_FIXTURE}
SELECT DISTINCT conversation_id, account_id, visitor_app_id AS app_id, conversation_source, visitor_device_type
FROM msg""",
}


def oracle_sql() -> dict[str, str]:
    found = {**_ORACLES, **_CORPUS_ORACLES}
    if _corpus_pipeline is not None and _corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = _corpus_pipeline.ORACLE_SQL
    return found
