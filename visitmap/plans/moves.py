"""Conversations that have moved from one report date to another between two runs.

A run rewrites the report dates of its window. A conversation that used to end on a date outside
the window and now ends inside would stay in the target twice. So a side table, the places, keeps
for every row of the target its conversation, its report date and its print. A run joins it with the
window's conversations; for those with a place outside the window, the rows of that date are built again from
the inputs, and where they have changed, the date is rewritten with all its other rows as they are.

A row that two conversations share (both without an account, and alike) goes only when both have moved.
A conversation that left the window for a date that no run covers comes back with the run that covers it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.functions.keys import contact_key
from visitmap.functions.prints import PRINT_COLS, add_prints
from visitmap.functions.window import DateWindow
from visitmap.operators.dedupe import dedupe
from visitmap.operators.explode import explode_ids
from visitmap.operators.link import rename_app_id
from visitmap.operators.project import conform
from visitmap.operators.stamp import add_build_stamp, add_report_date
from visitmap.schemas import EXPLODED_COLS, LINKED_COLS, OUTPUT_COLS, PARTITION_COL
from visitmap.session import scratch_path
from visitmap.sinks.files import drop_dates, stored_dates
from visitmap.sources.tables import scan_customer, scan_messaging

KEY = "conversation_id"
PLACES = T.StructType([T.StructField(KEY, T.StringType()), *[T.StructField(c, T.LongType()) for c in PRINT_COLS],
                       T.StructField(PARTITION_COL, T.DateType())])


def conversation_rows(cus: DataFrame, msg: DataFrame, build_ts: datetime | date | str | None = None) -> DataFrame:
    """The visit map's rows, each with the conversation it comes from (and once for each such)."""
    c, m = dedupe(scan_customer(cus)), dedupe(scan_messaging(msg))
    joined = c.join(rename_app_id(m), KEY, "inner").select(
        KEY, contact_key(F.col("account_id"), F.col(KEY)).alias("parent_contact_id"), *LINKED_COLS[1:])
    rows = add_build_stamp(add_report_date(dedupe(explode_ids(joined))), build_ts)
    return rows.select(KEY, *OUTPUT_COLS)


def conform_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``conversation_rows`` in the target's types, with their prints."""
    kept = T.StructType([T.StructField(KEY, T.StringType()), *schema.fields])
    return add_prints(conform(rows, kept), EXPLODED_COLS)


@dataclass
class Places:
    """The side table: a folder partitioned by report date."""

    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        if not stored_dates(spark, self.path):
            return spark.createDataFrame([], PLACES)
        return spark.read.schema(PLACES).parquet(self.path)

    def moved(self, keys: DataFrame, window: DateWindow) -> DataFrame:
        """Places outside ``window`` of the conversations in ``keys``, written."""
        spark = keys.sparkSession
        outside = self.read(spark).where(~F.col(PARTITION_COL).between(F.lit(window.start), F.lit(window.end)))
        path = scratch_path(spark, "moved")
        outside.join(keys.select(KEY).distinct(), KEY, "left_semi").write.parquet(path)
        return spark.read.schema(PLACES).parquet(path)

    def store(self, rows: DataFrame, complete: list[date]) -> None:
        """The places of the ``complete`` dates become those of ``rows``."""
        spark = rows.sparkSession
        out = rows.select(*PLACES.names).distinct()
        out.hint("rebalance", PARTITION_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COL).parquet(self.path)
        have = {r[0] for r in rows.select(PARTITION_COL).distinct().collect()}
        drop_dates(spark, self.path, sorted(set(complete) - have))


def rebuilt_dates(places: Places, moved: DataFrame, fresh: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame, list[date]]:
    """Rows and places of the dates outside the window that change, and these dates.

    ``fresh``: what the inputs have now for the ``moved`` conversations on those dates, with prints.
    ``target``: the target's rows as they are. Rows that stay keep their build stamp.
    """
    spark = moved.sparkSession
    at = [PARTITION_COL, *PRINT_COLS]
    who = moved.select(KEY, PARTITION_COL).distinct()
    dates = [r[0] for r in who.select(PARTITION_COL).distinct().collect()]
    known = places.read(spark).where(F.col(PARTITION_COL).isin(dates))
    others = known.join(who, [KEY, PARTITION_COL], "left_anti")
    fresh = fresh.join(who, [KEY, PARTITION_COL], "left_semi")
    gone = moved.select(*at).distinct().join(others.select(*at), at, "left_anti").join(fresh.select(*at), at, "left_anti")
    old = add_prints(target.where(F.col(PARTITION_COL).isin(dates)), EXPLODED_COLS)
    new = fresh.drop(KEY).dropDuplicates(at).join(old.select(*at), at, "left_anti")
    change = sorted({r[0] for r in gone.select(PARTITION_COL).union(new.select(PARTITION_COL)).distinct().collect()})
    stay = old.where(F.col(PARTITION_COL).isin(change)).join(gone, at, "left_anti")
    rows = stay.unionByName(new.where(F.col(PARTITION_COL).isin(change))).select(*OUTPUT_COLS)
    path = scratch_path(spark, "rebuilt")
    rows.write.parquet(path)
    now = others.select(*PLACES.names).unionByName(fresh.select(*PLACES.names))
    there = scratch_path(spark, "rebuilt-places")
    now.write.parquet(there)
    return spark.read.schema(rows.schema).parquet(path), spark.read.schema(PLACES).parquet(there), sorted(dates)
