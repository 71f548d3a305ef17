"""Catalog-table sinks: target DDL, insert by name, ORC export table (K1, K5, K6, K8).

Table names are bound with ``IDENTIFIER(:name)``; the only spliced text is a
location, which is checked to be a plain path first.
"""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from visitmap.operators.project import conform
from visitmap.schemas import PARTITION_COL, STAMP_COL, export_schema, output_schema
from visitmap.sinks.files import drop_dates, folder_names, remove_folder, stored_dates, written_dates

_SAFE_LOCATION = re.compile(r"^[A-Za-z0-9_:/.\-=+@]+$")


def _location(path: str) -> str:
    if not _SAFE_LOCATION.match(path):
        raise ValueError(f"refusing an unusual table location: {path!r}")
    return path


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_target_table(spark: SparkSession, table: str, location: str,
                        time_type: T.DataType = T.TimestampType()) -> None:
    """Partitioned Parquet target, created if missing.

    The report date is declared once, as the partition column, and the first
    column is ``parent_contact_id``, matching what the job writes. The table
    overwrites dynamically: an insert replaces only the dates it carries.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) ({_columns_ddl(output_schema(time_type))}) "
        f"USING parquet PARTITIONED BY ({PARTITION_COL}) LOCATION '{_location(location)}' "
        "OPTIONS ('partitionOverwriteMode' 'dynamic')",
        args={"t": table},
    )


def insert_overwrite_by_name(spark: SparkSession, df: DataFrame, table: str, rebalance: bool = True,
                             complete: list[date] | None = None) -> list[date]:
    """``INSERT OVERWRITE`` the dates in ``df``, matching columns by name.

    ``complete`` lists the dates for which ``df`` is the whole truth: those that it
    has no row for are emptied, by overwriting that one partition with nothing.
    """
    target = spark.table(table).schema
    out = conform(df, target)
    if rebalance:
        out = out.hint("rebalance", PARTITION_COL)
    out, seen = written_dates(out)
    spark.sql("INSERT OVERWRITE TABLE IDENTIFIER(:t) BY NAME SELECT * FROM {src}",
              args={"t": table}, src=out)
    dates = sorted(d for d in seen.get["dates"] if d is not None)
    if complete:
        empty_partitions(spark, table, sorted(set(complete) - set(dates)))
    return dates


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": table}).where("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def empty_partitions(spark: SparkSession, table: str, dates: list[date]) -> list[date]:
    """Take the partitions of ``dates`` that are there out of the table, by one statement, and their files away."""
    location = table_location(spark, table)
    there = sorted(set(stored_dates(spark, location)) & set(dates))
    if there:
        parts = ", ".join(f"PARTITION ({PARTITION_COL} = DATE '{d.isoformat()}')" for d in there)
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) DROP IF EXISTS {parts}", args={"t": table})
        drop_dates(spark, location, there)
    return there


def create_export_table(spark: SparkSession, table: str, location: str,
                        time_type: T.DataType = T.TimestampType()) -> None:
    """Drop and define the unpartitioned ORC export table."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": table})
    spark.sql(
        f"CREATE TABLE IDENTIFIER(:t) ({_columns_ddl(export_schema(time_type))}) "
        f"USING orc LOCATION '{_location(location)}'",
        args={"t": table},
    )


def replace_export_table(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Full refresh of the export table, by name."""
    out = conform(df, spark.table(table).schema)
    spark.sql("INSERT OVERWRITE TABLE IDENTIFIER(:t) BY NAME SELECT * FROM {src}",
              args={"t": table}, src=out)


def publish_export_table(spark: SparkSession, df: DataFrame, table: str, location: str) -> str:
    """Full refresh without a gap: a new version is written, then the table points to it. Returns its location.

    ``df`` has the target's columns. Readers see the old rows until the one statement that changes the table's
    location; a write that fails leaves table and rows as they were. The version before last is removed, the
    last one stays for queries that still read it. A table of other columns (or none) is defined anew, after the write.
    """
    time_type = df.schema[STAMP_COL].dataType
    schema = export_schema(time_type)
    root = _location(location).rstrip("/")
    fresh = f"{root}/version-{uuid.uuid4().hex}"
    try:
        conform(df, schema).write.orc(fresh)
    except Exception:
        remove_folder(spark, fresh)
        raise
    exists = spark.catalog.tableExists(table)
    old = table_location(spark, table) if exists else None
    if exists and [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in schema]:
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET LOCATION '{fresh}'", args={"t": table})
    else:
        create_export_table(spark, table, fresh, time_type)
    spark.catalog.refreshTable(table)
    keep = {fresh.rsplit("/", 1)[-1], (old or "").rstrip("/").rsplit("/", 1)[-1]}
    for name in folder_names(spark, root):
        if name.startswith("version-") and name not in keep:
            remove_folder(spark, f"{root}/{name}")
    return fresh
