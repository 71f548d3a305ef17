"""Windowed reruns into the date-partitioned target.

The job is re-run over a rolling window that overlaps earlier runs, so a
conversation that lands up to ``lookback_days`` late is still picked up. A run
overwrites exactly the report-date partitions it writes (dynamic overwrite).
For that to lose nothing, each written report date must be complete, so the
window is read in ``report_days`` mode: ``[start 07:00Z, end + 1 day 07:00Z)``
on the raw UTC column, still a pushable range. Dates of the window that a run
has no row for are emptied too. Two overlapping runs then leave the same table as
one run over both windows, also when rows moved or went between them.

Three things can be kept beside the target: ``Places``, by which a conversation that has moved here from a
date outside the window goes from there; ``DatePrints``, by which dates that haven't changed
aren't written; and ``Rejects``, which takes rows whose text times mean no time.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.functions.window import DEFAULT_LOOKBACK_DAYS, HISTORY_START, DateWindow
from visitmap.operators.project import conform
from visitmap.operators.stamp import add_report_date
from visitmap.plans.ledger import Ledger
from visitmap.plans.moves import KEY, PLACES, Places, conform_rows, conversation_rows, rebuilt_dates
from visitmap.plans.visit_map import build_visit_map
from visitmap.schemas import OUTPUT_COLS, PARTITION_COL, STAMP_COL
from visitmap.session import scratch_path
from visitmap.sinks.prints import DatePrints
from visitmap.sinks.target import Target, Written, as_target, write_dates
from visitmap.sources.rejects import WINDOW_COL, Rejects
from visitmap.sources.tables import resolve, scan_customer


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_window(
    cus: DataFrame | str,
    msg: DataFrame | str,
    window: DateWindow,
    target_path: str | Target,
    *,
    sides: str = "left",
    build_ts: datetime | date | str | None = None,
    rebalance: bool = True,
    spark: SparkSession | None = None,
    places: Places | None = None,
    prints: DatePrints | None = None,
    rejects: Rejects | None = None,
) -> Written | None:
    """Build the visit map for the report days of ``window`` and overwrite them.

    Returns what was written (None without ``places`` and ``prints``, when the rows go straight to the target).
    """
    window = window.with_mode("report_days")
    target = as_target(target_path)
    if rejects is not None:
        cus, msg = resolve(cus, spark), resolve(msg, spark)
        cus = rejects.sort_out(cus, "customer", window)
        if sides == "both":
            msg = rejects.sort_out(msg, "messaging", window, columns=[WINDOW_COL])
    if places is None and prints is None:
        df = build_visit_map(cus, msg, window, sides=sides, build_ts=build_ts, spark=spark)
        dates = target.overwrite(df, rebalance)
        target.empty(df.sparkSession, sorted(set(window.report_dates()) - set(dates)))
        return None
    if places is None:
        rows = _written(build_visit_map(cus, msg, window, sides=sides, build_ts=build_ts, spark=spark), "rerun")
        return write_dates(target, rows, window.report_dates(), prints, rebalance)
    return _run_with_places(resolve(cus, spark), resolve(msg, spark), window, target, sides, build_ts, rebalance, places, prints)


def _run_with_places(cus: DataFrame, msg: DataFrame, window: DateWindow, target: Target, sides: str, build_ts, rebalance: bool,
                     places: Places, prints: DatePrints | None) -> Written:
    spark = cus.sparkSession
    inside = window.apply(cus, WINDOW_COL)
    near = window.apply(msg, WINDOW_COL) if sides == "both" else msg
    plain = conversation_rows(inside, near, build_ts)
    schema = target.schema(spark, plain.schema[STAMP_COL].dataType)
    now = _written(conform_rows(plain, schema), "rerun")
    keys = _written(inside.select(F.col(KEY).cast("string").alias(KEY)).where(F.col(KEY).isNotNull()).distinct(), "rerun-keys")
    moved = places.moved(keys, window)
    days = sorted(r[0] for r in moved.select(PARTITION_COL).distinct().collect())
    rows, place_rows, complete = now.select(*OUTPUT_COLS).dropDuplicates([c for c in OUTPUT_COLS if c != STAMP_COL]), now.select(*PLACES.names), window.report_dates()
    if days:
        # The moved conversations on their old dates, as the inputs have them now: the scan is cut to these days.
        span = DateWindow(days[0], days[-1], "report_days")
        then = add_report_date(scan_customer(cus, span)).where(F.col(PARTITION_COL).isin(days)).drop(PARTITION_COL)
        then = then.join(moved.select(KEY).distinct(), KEY, "left_semi")
        # A messaging row counts on a date outside the window by the rule that wrote that date.
        there = span.apply(msg, WINDOW_COL) if sides == "both" else msg
        fresh = _written(conform_rows(conversation_rows(then, there, build_ts), schema), "rerun-moved")
        old = conform(target.read(spark, schema[STAMP_COL].dataType), schema)
        more, more_places, dates = rebuilt_dates(places, moved, fresh, old)
        rows, place_rows, complete = rows.unionByName(more), place_rows.unionByName(more_places), complete + dates
        changed = {r[0] for r in more.select(PARTITION_COL).distinct().collect()}
        stay = [d for d in dates if d not in changed]
        # Dates whose rows all went are emptied; dates where nothing changes have no rows here and stay.
        left = {r[0] for r in more_places.select(PARTITION_COL).distinct().collect()}
        done = write_dates(target, _written(rows, "rerun-all"), [d for d in complete if d not in stay or d not in left], prints, rebalance)
    else:
        done = write_dates(target, rows, complete, prints, rebalance)
    places.store(place_rows, complete)
    return done


def rolling_run(
    cus: DataFrame | str,
    msg: DataFrame | str,
    target_path: str | Target,
    *,
    as_of: date | str | None = None,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
    **kwargs,
) -> DateWindow:
    """The scheduled run: report days yesterday-``lookback_days`` .. yesterday (MST)."""
    window = DateWindow.rolling(as_of, lookback_days, mode="report_days")
    run_window(cus, msg, window, target_path, **kwargs)
    return window


def backfill_run(
    cus: DataFrame | str,
    msg: DataFrame | str,
    target_path: str | Target,
    *,
    as_of: date | str | None = None,
    start: date | str = HISTORY_START,
    ledger: Ledger | None = None,
    slice_days: int = 90,
    **kwargs,
) -> DateWindow:
    """The history run: report days ``start`` .. yesterday (MST).

    Every report date in the range is rewritten; dates outside it are kept. With a ``ledger`` the range is
    run in slices of ``slice_days`` days, and a run that was cut off goes on with the first slice that isn't done.
    """
    window = DateWindow.backfill(as_of, start, mode="report_days")
    if ledger is None:
        run_window(cus, msg, window, target_path, **kwargs)
        return window
    session = kwargs.get("spark") or SparkSession.active()
    for part in ledger.open_slices(session, window, slice_days):
        run_window(cus, msg, part, target_path, **kwargs)
        ledger.done(session, window, part)
    return window
