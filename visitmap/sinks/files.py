"""Path-based sinks.

Writes go through Spark's file commit protocol: task output is staged and only
a committed job replaces partitions, so a lost executor makes Spark retry
tasks, never leave a half-written partition.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.operators.project import conform
from visitmap.schemas import OUTPUT_COLS, PARTITION_COL, STAMP_COL, output_schema


def written_dates(df: DataFrame, partition_col: str = PARTITION_COL) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of the dates that pass when it is written."""
    seen = Observation()
    return df.observe(seen, F.collect_set(partition_col).alias("dates")), seen


def overwrite_partitions(df: DataFrame, path: str, partition_col: str = PARTITION_COL,
                         rebalance: bool = True, fmt: str = "parquet", complete: list[date] | None = None) -> list[date]:
    """Replace the ``partition_col`` partitions that ``df`` contains; keep the rest.

    ``complete`` lists the dates for which ``df`` is the whole truth: those that it has
    no row for are emptied too. Returns the dates written. The columns must be the contract's, no more and no less.
    ``rebalance`` shuffles rows by the partition column before the write so
    each date gets few, large files; AQE splits a date that is too big for one
    task and merges small ones (the small-file merge of the original job).
    """
    schema = output_schema(df.schema[STAMP_COL].dataType if STAMP_COL in df.columns else T.TimestampType())
    out = conform(df, schema)
    if rebalance:
        out = out.hint("rebalance", partition_col)
    out, seen = written_dates(out, partition_col)
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .format(fmt)
        .save(path))
    dates = sorted(d for d in seen.get["dates"] if d is not None)
    if complete:
        drop_dates(df.sparkSession, path, sorted(set(complete) - set(dates)), partition_col)
    return dates


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    where, files = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    where, files = _folder(spark, path)
    files.delete(where, True)


def stored_dates(spark: SparkSession, path: str, partition_col: str = PARTITION_COL) -> list[date]:
    """The dates that have a folder under ``path``; a listing, no Spark job."""
    found = [n.split("=", 1)[1] for n in folder_names(spark, path) if n.startswith(f"{partition_col}=")]
    return sorted(date.fromisoformat(x) for x in found if x[:1].isdigit())


def drop_dates(spark: SparkSession, path: str, dates: list[date], partition_col: str = PARTITION_COL) -> list[date]:
    """Remove the folders of ``dates`` that are there: one listing and one delete each, no Spark job, however many.

    Deleting again what is gone already changes nothing, so a run that was cut off can be repeated.
    """
    there = sorted(set(stored_dates(spark, path, partition_col)) & set(dates))
    for day in there:
        remove_folder(spark, f"{path.rstrip('/')}/{partition_col}={day.isoformat()}")
    return there


def export_orc(df: DataFrame, path: str) -> None:
    """Full refresh of the unpartitioned ORC export; report date as yyyy-MM-dd text.

    The rows are written beside the old export, which gives way only when all of
    them are there: a write that fails leaves the old export as it was.
    """
    out = conform(df, OUTPUT_COLS).withColumn(PARTITION_COL, F.col(PARTITION_COL).cast("string"))
    spark, tag = df.sparkSession, uuid.uuid4().hex[:12]
    staged, before = f"{path.rstrip('/')}.staged-{tag}", f"{path.rstrip('/')}.old-{tag}"
    try:
        out.write.orc(staged)
    except Exception:
        remove_folder(spark, staged)
        raise
    where, files = _folder(spark, path)
    new, old = _folder(spark, staged)[0], _folder(spark, before)[0]
    had = files.exists(where)
    if had and not files.rename(where, old):
        raise OSError(f"the old export can't be moved: {path}")
    if not files.rename(new, where):
        if had:
            files.rename(old, where)
        raise OSError(f"the new export can't be moved to {path}")
    if had:
        files.delete(old, True)
