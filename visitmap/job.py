"""The scheduled visit-map job (``spark-submit visitmap/job.py ...`` or ``python -m visitmap ...``).

Everything the original job looked up at import time (environment, dates,
table names) is an argument here. One run:

1. picks the window: rolling (yesterday MST and ``--lookback-days`` before) or
   a history backfill, read as whole MST report days unless ``--window-mode`` says
   otherwise (``closed`` reads DATE or midnight values as the original job does);
2. builds the visit map from the two inputs (catalog tables or Parquet paths),
   over a written slice of the window's customer rows; with ``--messaging-layout`` messaging is
   joined where it lies (``plans.layout``);
3. overwrites the report-date partitions it produced in the target (a
   Parquet folder, or a catalog table created on first use) and empties those of
   the window that no longer have rows;
   with ``--places-path`` conversations that have moved here from a date outside the window go from there, with
   ``--prints-path`` dates that haven't changed aren't written, with ``--ledger-path`` a backfill that was
   cut off goes on where it stopped, with ``--reject-path`` rows whose text times mean no time are kept apart;
4. optionally refreshes the unpartitioned ORC export (a folder or a catalog
   table) from what was just written.

The run applies ``session.RECOMMENDED_CONF`` and restores the session's settings
afterwards; ``--conf`` wins over it.
"""

from __future__ import annotations

import argparse
import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap import session
from visitmap.functions.timefns import mst_now, stamp_text
from visitmap.functions.window import DEFAULT_LOOKBACK_DAYS, HISTORY_START, DateWindow
from visitmap.operators.project import conform
from visitmap.plans.layout import MessagingLayout
from visitmap.plans.ledger import Ledger
from visitmap.plans.moves import Places
from visitmap.plans.rerun import backfill_run, run_window
from visitmap.plans.visit_map import scheduled_visit_map
from visitmap.schemas import PARTITION_COL, output_schema
from visitmap.sinks.files import export_orc, overwrite_partitions
from visitmap.sinks.tables import create_target_table, insert_overwrite_by_name, publish_export_table
from visitmap.sinks.prints import DatePrints
from visitmap.sinks.target import PathTarget, TableTarget
from visitmap.sources.rejects import WINDOW_COL, Rejects
from visitmap.sources.tables import read_target

log = logging.getLogger("visitmap")


def _source(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or Parquet when the name looks like a path."""
    if "/" in name:
        return spark.read.parquet(name)
    return spark.table(name)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="visitmap", description=__doc__.splitlines()[0])
    p.add_argument("--customer", required=True, help="customer messaging table or Parquet path")
    p.add_argument("--messaging", help="messaging table or Parquet path")
    p.add_argument("--messaging-layout", help="messaging laid out by create_layout, instead of --messaging (customer-side window only)")
    p.add_argument("--target-path", help="Parquet folder of the partitioned target")
    p.add_argument("--target-table", help="catalog table of the target (created if missing)")
    p.add_argument("--target-location", help="location for a new --target-table")
    p.add_argument("--export-path", help="ORC folder to refresh with this run's rows")
    p.add_argument("--export-table", help="catalog table to refresh with this run's rows (a new version is written, then the table points to it)")
    p.add_argument("--export-location", help="folder of --export-table's versions")
    p.add_argument("--window-mode", choices=("report_days", "closed", "whole_days"), default="report_days",
                   help="how the window's days are read on the end date; closed compares with both bounds at midnight UTC")
    p.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="a Spark SQL setting for the run")
    p.add_argument("--hive", action="store_true", help="use the Hive catalog")
    p.add_argument("--as-of", type=date.fromisoformat, help="run as if today (MST) were this day")
    p.add_argument("--lookback-days", type=int, default=DEFAULT_LOOKBACK_DAYS)
    p.add_argument("--backfill", action="store_true", help="history run from --history-start")
    p.add_argument("--history-start", type=date.fromisoformat, default=HISTORY_START)
    p.add_argument("--places-path", help="folder of the side table conversation -> report date (whole report days only)")
    p.add_argument("--prints-path", help="folder of the dates' prints (whole report days only)")
    p.add_argument("--ledger-path", help="folder of the run ledger of a backfill")
    p.add_argument("--slice-days", type=int, default=90, help="days of one slice of a backfill with a ledger")
    p.add_argument("--reject-path", help="folder of the reject table")
    p.add_argument("--sides", choices=("left", "both"), default="left",
                   help="window the customer side only (scheduled job) or both inputs")
    p.add_argument("--prededupe", choices=("auto", "messaging", "both", "none"), default="auto")
    p.add_argument("--build-ts", help="build stamp (MST wall clock); default: now")
    p.add_argument("--shuffle-partitions", type=int,
                   help="initial shuffle width (about largest stage input / 128 MB); AQE coalesces "
                        "from there. Default: the session's setting")
    args = p.parse_args(argv)
    if bool(args.target_path) == bool(args.target_table):
        p.error("give exactly one of --target-path and --target-table")
    if bool(args.messaging) == bool(args.messaging_layout):
        p.error("give exactly one of --messaging and --messaging-layout")
    if args.messaging_layout and (args.sides == "both" or args.places_path or args.prints_path or args.ledger_path):
        p.error("--messaging-layout goes with --sides left, without --places-path, --prints-path and --ledger-path")
    if args.window_mode != "report_days" and (args.places_path or args.prints_path or args.ledger_path):
        p.error("--places-path, --prints-path and --ledger-path need --window-mode report_days")
    if args.ledger_path and not args.backfill:
        p.error("--ledger-path goes with --backfill")
    if bool(args.export_table) != bool(args.export_location):
        p.error("--export-table and --export-location go together")
    if any("=" not in x for x in args.conf):
        p.error("--conf takes KEY=VALUE")
    return args


def settings(args: argparse.Namespace) -> dict[str, str]:
    """The run's settings: the recommended ones, the arguments', then the explicit ones."""
    found = dict(session.RECOMMENDED_CONF)
    if args.shuffle_partitions:
        # AQE can merge small partitions and split skewed ones, but not split a
        # uniformly oversized one: start wide enough for the data.
        found["spark.sql.shuffle.partitions"] = str(args.shuffle_partitions)
    return found | dict(x.split("=", 1) for x in args.conf)


def run(spark: SparkSession, args: argparse.Namespace) -> DateWindow:
    with session.apply(spark, settings(args)):
        return _run(spark, args)


def _run(spark: SparkSession, args: argparse.Namespace) -> DateWindow:
    if args.backfill:
        window = DateWindow.backfill(args.as_of, args.history_start, mode=args.window_mode)
    else:
        window = DateWindow.rolling(args.as_of, args.lookback_days, mode=args.window_mode)
    build_ts = args.build_ts or mst_now()          # one clock read per run
    log.info("visit map for %s %s..%s, build %s", window.mode, window.start, window.end, stamp_text(build_ts))
    cus = _source(spark, args.customer)
    msg = MessagingLayout(args.messaging_layout) if args.messaging_layout else _source(spark, args.messaging)
    rejects = Rejects(args.reject_path) if args.reject_path else None
    if args.places_path or args.prints_path or args.ledger_path:
        dates, written = _kept_run(spark, args, cus, msg, window, build_ts, rejects)
    else:
        if rejects is not None:
            cus = rejects.sort_out(cus, "customer", window)
            if args.sides == "both":
                msg = rejects.sort_out(msg, "messaging", window, columns=[WINDOW_COL])
        df, sized = scheduled_visit_map(spark, cus, msg, window, sides=args.sides, build_ts=build_ts, prededupe=args.prededupe)
        time_type = df.schema["etl_build_mst_ts"].dataType
        # Only whole report days tell that a date has become empty.
        complete = window.report_dates() if window.mode == "report_days" else None
        with session.apply(spark, sized, keep=[x.split("=", 1)[0] for x in args.conf]):
            if args.target_path:
                dates = overwrite_partitions(df, args.target_path, complete=complete)
                written = read_target(spark, args.target_path, time_type)
            else:
                _make_target(spark, args, time_type)
                dates = insert_overwrite_by_name(spark, df, args.target_table, complete=complete)
                written = spark.table(args.target_table)
    # The export is what was just written, so both are the same rows and the inputs are read once.
    rows = written.where(F.col(PARTITION_COL).isin(dates)) if dates else written.limit(0)
    if args.export_path:
        export_orc(rows, args.export_path)
    if args.export_table:
        kept = rows.schema["etl_build_mst_ts"].dataType
        publish_export_table(spark, conform(rows, output_schema(kept)), args.export_table, args.export_location)
    return window


def _make_target(spark: SparkSession, args: argparse.Namespace, time_type) -> None:
    if not spark.catalog.tableExists(args.target_table):
        if not args.target_location:
            raise SystemExit("--target-location is needed to create --target-table")
        create_target_table(spark, args.target_table, args.target_location, time_type=time_type)


def _kept_run(spark: SparkSession, args: argparse.Namespace, cus: DataFrame, msg: DataFrame, window: DateWindow, build_ts, rejects: Rejects | None
              ) -> tuple[list[date], DataFrame]:
    """A run with what is kept beside the target: the window's dates and the target."""
    kept = {"sides": args.sides, "build_ts": build_ts, "spark": spark, "rejects": rejects,
            "places": Places(args.places_path) if args.places_path else None, "prints": DatePrints(args.prints_path) if args.prints_path else None}
    end = cus.schema["conversation_end_utc_ts"].dataType
    # Sorted-out text becomes a wall clock.
    time_type = T.TimestampNTZType() if rejects is not None and isinstance(end, T.StringType) else end if isinstance(end, T.TimestampNTZType) else T.TimestampType()
    if args.target_path:
        target = PathTarget(args.target_path)
    else:
        _make_target(spark, args, time_type)
        target = TableTarget(args.target_table)
    if args.ledger_path:
        backfill_run(cus, msg, target, as_of=args.as_of, start=args.history_start, ledger=Ledger(args.ledger_path), slice_days=args.slice_days, **kept)
    else:
        run_window(cus, msg, window, target, **kept)
    return window.report_dates(), target.read(spark, time_type)


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parse_args(argv)
    builder = SparkSession.builder.appName("visitmap")
    if args.hive:
        builder = builder.enableHiveSupport()
    run(builder.getOrCreate(), args)


if __name__ == "__main__":
    main()
