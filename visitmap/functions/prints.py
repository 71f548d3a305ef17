"""Row prints: two 64-bit hashes of a row, the same for equal rows whatever wrote them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRINT_COLS = ["print_a", "print_b"]


def _hash(df: DataFrame, seed: int, columns: list[str]) -> Column:
    # Spark's hash passes over NULLs, so their places go in as a column of their own; nested
    # values go in as text that shows theirs.
    nulls = F.concat(F.lit(""), *[F.when(F.col(f"`{c}`").isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    nested = (T.ArrayType, T.StructType, T.MapType)
    value = lambda c: F.to_json(F.struct(F.col(f"`{c}`")), {"ignoreNullFields": "false"}) if isinstance(df.schema[c].dataType, nested) else F.col(f"`{c}`")
    return F.xxhash64(F.lit(seed), nulls, *[value(c) for c in columns])


def add_prints(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with the print of ``columns``. Equal values of equal types give equal prints."""
    return df.withColumns({name: _hash(df, seed, columns) for seed, name in enumerate(PRINT_COLS)})


def print_sums(columns: list[str] = PRINT_COLS) -> list[Column]:
    """Aggregates that tell a set of rows from another in any order, and that can be merged: count and sums."""
    return [F.count("*").alias("n"), *[F.sum(F.col(c).cast("decimal(20,0)")).alias(f"sum_{c}") for c in columns]]
