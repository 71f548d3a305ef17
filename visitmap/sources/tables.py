"""Windowed, column-pruned scans of the two messaging inputs.

An input is a catalog table name or a DataFrame. The window predicate and the
projection are declared on the DataFrame; Catalyst pushes both into the file
scan (PushedFilters / ReadSchema), through any derived-column projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from visitmap.functions.window import DateWindow
from visitmap.schemas import CUSTOMER_COLS, MESSAGING_COLS, output_schema

WINDOW_COL = "conversation_end_utc_date"


def resolve(source: DataFrame | str, spark: SparkSession | None = None) -> DataFrame:
    """A DataFrame for ``source``: itself, or ``spark.table(source)``."""
    if isinstance(source, DataFrame):
        return source
    spark = spark or SparkSession.active()
    return spark.table(source)


def scan_customer(source: DataFrame | str, window: DateWindow | None = None,
                  spark: SparkSession | None = None) -> DataFrame:
    """Customer messaging rows in ``window``: the 5 columns the job reads."""
    df = resolve(source, spark)
    if window is not None:
        df = window.apply(df, WINDOW_COL)
    return df.select(*CUSTOMER_COLS)


def scan_messaging(source: DataFrame | str, window: DateWindow | None = None,
                   spark: SparkSession | None = None) -> DataFrame:
    """Messaging rows (5 columns), filtered on their own end date if ``window``."""
    df = resolve(source, spark)
    if window is not None:
        df = window.apply(df, WINDOW_COL)
    return df.select(*MESSAGING_COLS)


def read_target(spark: SparkSession, path: str, time_type: T.DataType = T.TimestampType(),
                fmt: str = "parquet") -> DataFrame:
    """The partitioned target, read with its declared schema.

    The report date comes back as DATE whatever the session's partition-type
    inference says, and a filter on it prunes partitions.
    """
    return spark.read.schema(output_schema(time_type)).format(fmt).load(path)
