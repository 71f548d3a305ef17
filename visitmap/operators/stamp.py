"""Report date and build stamp columns (C4-C11)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.functions.timefns import build_stamp_literal, report_date

_TIME_TYPES = (T.TimestampType, T.TimestampNTZType)


def add_report_date(df: DataFrame, source_col: str = "conversation_end_utc_date",
                    out_col: str = "rpt_mst_date") -> DataFrame:
    """``out_col`` = MST calendar date of the UTC value in ``source_col``."""
    return df.withColumn(out_col, report_date(F.col(source_col), df.schema[source_col].dataType))


def stamp_type(df: DataFrame, like: str = "conversation_end_utc_ts") -> T.DataType:
    """The stamp follows the inputs' time type: NTZ in, NTZ out; else TIMESTAMP."""
    if like in df.columns and isinstance(df.schema[like].dataType, _TIME_TYPES):
        return df.schema[like].dataType
    return T.TimestampType()


def add_build_stamp(df: DataFrame, build_ts: datetime | date | str | None = None,
                    out_col: str = "etl_build_mst_ts", data_type: T.DataType | None = None) -> DataFrame:
    """Add the run's build time (MST) as one literal on every row.

    ``build_ts`` is injected (tests, reruns); ``None`` reads the driver clock
    once, when the plan is built.
    """
    return df.withColumn(out_col, build_stamp_literal(build_ts, data_type or stamp_type(df)))


def add_query_clock(df: DataFrame, out_col: str = "query_ts") -> DataFrame:
    """Add the time at which the query runs, the same on every row; a plan run again reads the clock again."""
    return df.withColumn(out_col, F.current_timestamp())


def overwrite_with_build_time(df: DataFrame, column: str, build_ts: datetime | date | str | None = None
                              ) -> DataFrame:
    """Replace ``column`` by the build time, keeping its time type."""
    return add_build_stamp(df, build_ts, out_col=column, data_type=stamp_type(df, column))
