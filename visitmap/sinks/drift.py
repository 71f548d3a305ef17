"""A contract that grows (K5, K8): columns added to the catalog table, types widened, old and new partitions read together."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from visitmap.schemas import PARTITION_COL
from visitmap.sinks.tables import _columns_ddl, _location, table_location

# What the Parquet scan reads as a wider type without loss.
WIDER = {
    ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"),
    ("int", "double"), ("float", "double"), ("date", "timestamp_ntz"),
}


def widens(have: T.DataType, want: T.DataType) -> bool:
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return want.scale >= have.scale and want.precision - want.scale >= have.precision - have.scale
    return (have.simpleString(), want.simpleString()) in WIDER


@dataclass
class Drift:
    """How a contract differs from what is stored."""

    added: list[T.StructField] = field(default_factory=list)  # in the contract only
    widened: list[T.StructField] = field(default_factory=list)  # of a wider type in the contract
    clashing: list[str] = field(default_factory=list)  # of types that can't be read as the contract's
    only_stored: list[str] = field(default_factory=list)  # not in the contract

    def __bool__(self) -> bool:
        return bool(self.added or self.widened or self.clashing or self.only_stored)


def compare_schemas(stored: T.StructType, contract: T.StructType) -> Drift:
    """By name, in any letter case, as the catalog compares names; order and nullability don't count."""
    have = {f.name.lower(): f for f in stored.fields}
    drift = Drift(only_stored=[f.name for f in stored.fields if f.name.lower() not in {c.name.lower() for c in contract.fields}])
    for want in contract.fields:
        old = have.get(want.name.lower())
        if old is None:
            drift.added.append(T.StructField(want.name, want.dataType, True))
        elif old.dataType != want.dataType:
            if widens(old.dataType, want.dataType) and want.name != PARTITION_COL:
                drift.widened.append(T.StructField(old.name, want.dataType, True))
            else:
                drift.clashing.append(f"{want.name}: {old.dataType.simpleString()} stored, {want.dataType.simpleString()} asked")
    return drift


def evolve_table(spark: SparkSession, table: str, contract: T.StructType) -> Drift:
    """Bring a target table's definition to ``contract``; no file is read or written. Returns what differed.

    New columns go in by ``ALTER TABLE ADD COLUMNS`` and are NULL in older partitions. A wider type needs
    a new definition over the same location, with the partitions found again; only an external table can have that.
    Types that can't be widened raise, with nothing changed. Columns that only the table has stay in it.
    """
    stored = spark.table(table).schema
    drift = compare_schemas(stored, contract)
    if drift.clashing:
        raise ValueError(f"the table can't take the contract's types: {drift.clashing}")
    if drift.widened:
        about = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": table})
        kind = about.where("col_name = 'Type'").collect()[-1]["data_type"]
        if kind != "EXTERNAL":
            raise ValueError(f"only an external table can be widened; {table} is {kind}")
        wide = {f.name: f for f in drift.widened}
        fields = [wide.get(f.name, f) for f in stored.fields if f.name != PARTITION_COL] + drift.added + [stored[PARTITION_COL]]
        location = _location(table_location(spark, table))
        spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": table})
        spark.sql(f"CREATE TABLE IDENTIFIER(:t) ({_columns_ddl(T.StructType(fields))}) USING parquet PARTITIONED BY ({PARTITION_COL}) "
                  f"LOCATION '{location}' OPTIONS ('partitionOverwriteMode' 'dynamic')", args={"t": table})
        spark.sql("ALTER TABLE IDENTIFIER(:t) RECOVER PARTITIONS", args={"t": table})
    elif drift.added:
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) ADD COLUMNS ({_columns_ddl(T.StructType(drift.added))})", args={"t": table})
    spark.catalog.refreshTable(table)
    return drift


def read_evolved(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """All partitions as ``contract``: columns older files don't have are NULL, narrower ones are widened by the scan."""
    return spark.read.schema(contract).parquet(path)
