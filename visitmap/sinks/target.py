"""The partitioned target, a folder or a catalog table, behind one interface for reruns."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.operators.project import conform
from visitmap.schemas import PARTITION_COL, STAMP_COL, output_schema
from visitmap.sinks.files import drop_dates, overwrite_partitions, stored_dates
from visitmap.sinks.prints import DatePrints
from visitmap.sinks.tables import empty_partitions, insert_overwrite_by_name, table_location
from visitmap.sources.tables import read_target


@dataclass
class PathTarget:
    path: str

    def schema(self, spark: SparkSession, stamp: T.DataType) -> T.StructType:
        return output_schema(stamp)

    def read(self, spark: SparkSession, stamp: T.DataType) -> DataFrame:
        return read_target(spark, self.path, stamp)

    def dates(self, spark: SparkSession) -> list[date]:
        return stored_dates(spark, self.path)

    def overwrite(self, df: DataFrame, rebalance: bool = True) -> list[date]:
        return overwrite_partitions(df, self.path, rebalance=rebalance)

    def empty(self, spark: SparkSession, dates: list[date]) -> list[date]:
        return drop_dates(spark, self.path, dates)


@dataclass
class TableTarget:
    table: str

    def schema(self, spark: SparkSession, stamp: T.DataType) -> T.StructType:
        return spark.table(self.table).schema

    def read(self, spark: SparkSession, stamp: T.DataType) -> DataFrame:
        return spark.table(self.table)

    def dates(self, spark: SparkSession) -> list[date]:
        return stored_dates(spark, table_location(spark, self.table))

    def overwrite(self, df: DataFrame, rebalance: bool = True) -> list[date]:
        return insert_overwrite_by_name(spark_of(df), df, self.table, rebalance=rebalance)

    def empty(self, spark: SparkSession, dates: list[date]) -> list[date]:
        return empty_partitions(spark, self.table, dates)


Target = PathTarget | TableTarget


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def as_target(target: str | Target) -> Target:
    return PathTarget(target) if isinstance(target, str) else target


@dataclass
class Written:
    """What a write did: dates written, dates emptied, and dates left alone because nothing in them changed."""

    written: list[date]
    emptied: list[date]
    unchanged: list[date]


def write_dates(target: str | Target, rows: DataFrame, complete: list[date], prints: DatePrints | None = None, rebalance: bool = True) -> Written:
    """Make the ``complete`` dates of the target what ``rows`` has for them.

    ``rows`` is read more than once, so it should be a written table. With ``prints`` only the dates
    whose rows differ from what was written last are written, and none if nothing has changed.
    """
    spark, target = rows.sparkSession, as_target(target)
    rows = conform(rows, target.schema(spark, rows.schema[STAMP_COL].dataType))
    there = target.dates(spark)
    have = sorted(r[0] for r in rows.select(PARTITION_COL).distinct().collect() if r[0] is not None)
    # A date whose folder is gone is written whatever its print says.
    changed = have if prints is None else sorted(set(prints.changed(rows)) | (set(have) - set(there)))
    gone = sorted((set(complete) - set(have)) & set(there))
    mine = rows.where(F.col(PARTITION_COL).isin(changed)) if changed != have else rows
    if prints is not None:
        prints.forget(spark, changed + gone)
    if changed:
        target.overwrite(mine, rebalance)
    if gone:
        target.empty(spark, gone)
    if prints is not None and changed:
        prints.store(mine)
    return Written(changed, gone, sorted(set(have) - set(changed)))
