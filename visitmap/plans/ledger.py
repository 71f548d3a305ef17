"""The run ledger of a history run: which slices of its dates are done.

A row is added when a slice has been written. A run that was cut off, started again with the same
range, finds its rows and goes on; the slice in which it stopped is written again as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.functions.window import DateWindow
from visitmap.sinks.files import folder_names

SCHEMA = T.StructType([T.StructField(c, T.DateType()) for c in ("run_start", "run_end", "slice_start", "slice_end")]
                      + [T.StructField("finished_at", T.TimestampType())])


def slices(window: DateWindow, days: int) -> list[DateWindow]:
    """``window`` cut into windows of ``days`` days, the last one shorter."""
    if days < 1:
        raise ValueError("a slice has at least one day")
    out, at = [], window.start
    while at <= window.end:
        stop = min(at + timedelta(days=days - 1), window.end)
        out.append(DateWindow(at, stop, window.mode))
        at = stop + timedelta(days=1)
    return out


@dataclass
class Ledger:
    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        if not any(n.endswith(".parquet") for n in folder_names(spark, self.path)):
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).parquet(self.path)

    def open_slices(self, spark: SparkSession, window: DateWindow, days: int) -> list[DateWindow]:
        """The slices of ``window`` with a date that isn't done, in order."""
        mine = self.read(spark).where((F.col("run_start") == F.lit(window.start)) & (F.col("run_end") == F.lit(window.end)))
        done = {(r.slice_start, r.slice_end) for r in mine.select("slice_start", "slice_end").distinct().collect()}
        covered = {d for a, b in done for d in DateWindow(a, b).report_dates()}
        return [w for w in slices(window, days) if not set(w.report_dates()) <= covered]

    def done(self, spark: SparkSession, window: DateWindow, part: DateWindow) -> None:
        row = spark.range(1).select(F.lit(window.start).alias("run_start"), F.lit(window.end).alias("run_end"), F.lit(part.start).alias("slice_start"),
                                    F.lit(part.end).alias("slice_end"), F.current_timestamp().alias("finished_at"))
        row.coalesce(1).write.mode("append").parquet(self.path)
