"""Compaction of a partitioned Parquet target after its writes (K7): only dates of many small files are written anew."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.schemas import PARTITION_COL
from visitmap.sinks.files import _folder, folder_names, remove_folder
from visitmap.sinks.tables import table_location

SMALL_BYTES = 32 << 20
AT_LEAST = 4
_WORK = "_compact-"  # readers pass over folders that begin so


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """A row each data file with rows: report date, file, bytes. From the scan's own metadata; no column is read."""
    only_date = T.StructType([T.StructField(PARTITION_COL, T.DateType())])
    files = spark.read.schema(only_date).parquet(path)
    return files.select(PARTITION_COL, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct()


def fragmented_dates(spark: SparkSession, path: str, small_bytes: int = SMALL_BYTES, at_least: int = AT_LEAST) -> list[date]:
    """The dates with ``at_least`` files under ``small_bytes``."""
    small = file_sizes(spark, path).where(F.col("bytes") < small_bytes).groupBy(PARTITION_COL).count()
    return sorted(r[0] for r in small.where((F.col("count") >= at_least) & F.col(PARTITION_COL).isNotNull()).collect())


def _move(spark: SparkSession, here: str, there: str) -> None:
    source, files = _folder(spark, here)
    target = _folder(spark, there)[0]
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{here} can't be moved to {there}")


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Undo what a killed compaction left: a date moved away without its new files comes back."""
    root = path.rstrip("/")
    there = set(folder_names(spark, root))
    for work in sorted(n for n in there if n.startswith(_WORK)):
        for part in folder_names(spark, f"{root}/{work}/old"):
            if part not in there:
                _move(spark, f"{root}/{work}/old/{part}", f"{root}/{part}")
        remove_folder(spark, f"{root}/{work}")


def compact_dates(spark: SparkSession, path: str, small_bytes: int = SMALL_BYTES, at_least: int = AT_LEAST,
                  schema: T.StructType | None = None) -> list[date]:
    """Write the fragmented dates anew, in files of the advisory partition size; all other dates keep their files.

    The rows, build stamps included, stay as they are; their number is held against the old files' before
    any of these moves. A date's old files give way by one move and are deleted at the end, so a
    run killed at any time loses nothing (the next one finishes it). ``schema``: the columns, where dates
    differ in them; else all files' columns merged. Like reruns, one at a time to a target.
    """
    root = path.rstrip("/")
    finish_compaction(spark, root)
    dates = fragmented_dates(spark, root, small_bytes, at_least)
    if not dates:
        return []
    work = f"{root}/{_WORK}{uuid.uuid4().hex[:12]}"
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    rows = reader.parquet(root).where(F.col(PARTITION_COL).cast("date").isin(dates))
    try:
        rows.hint("rebalance", PARTITION_COL).write.partitionBy(PARTITION_COL).parquet(f"{work}/new")
        n, written = rows.count(), spark.read.schema(rows.schema).parquet(f"{work}/new").count()
        if n != written:
            raise RuntimeError(f"{path} changed while it was compacted: {n} rows, {written} written")
    except Exception:
        remove_folder(spark, work)
        raise
    for day in dates:
        part = f"{PARTITION_COL}={day.isoformat()}"
        _move(spark, f"{root}/{part}", f"{work}/old/{part}")
        _move(spark, f"{work}/new/{part}", f"{root}/{part}")
    remove_folder(spark, work)
    return dates


def compact_table(spark: SparkSession, table: str, small_bytes: int = SMALL_BYTES, at_least: int = AT_LEAST) -> list[date]:
    """``compact_dates`` for a catalog table; its partitions keep their locations."""
    dates = compact_dates(spark, table_location(spark, table), small_bytes, at_least, spark.table(table).schema)
    spark.catalog.refreshTable(table)
    return dates
