"""Comparison of two tables as multisets of rows (E5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmap.functions.prints import PRINT_COLS, add_prints


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that the tables don't have equally often, each once, with ``n_left`` and ``n_right``.

    Columns are matched by name and have to have equal types; order doesn't count, NULLs are equal. Rows are counted by their
    print (two 64-bit hashes), which is what is shuffled: copies collapse in the map task, and the
    rows themselves are fetched only for prints whose counts differ. No rows: the tables are equal.
    """
    names = left.columns
    if sorted(names) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(set(names) ^ set(right.columns))}")
    right = right.select(*names)
    kinds = [(f.name, f.dataType, right.schema[f.name].dataType) for f in left.schema if f.dataType != right.schema[f.name].dataType]
    if kinds:
        raise ValueError(f"types differ: {kinds}")
    taken = {"n_left", "n_right", *PRINT_COLS} & set(names)
    if taken:
        raise ValueError(f"column names that the result needs: {sorted(taken)}")
    left, right = add_prints(left, names), add_prints(right, names)

    def counted(df: DataFrame, one: int, other: int) -> DataFrame:
        return df.select(*PRINT_COLS, F.lit(one).alias("l"), F.lit(other).alias("r"))

    counts = counted(left, 1, 0).unionAll(counted(right, 0, 1)).groupBy(*PRINT_COLS).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
    uneven = counts.where("n_left <> n_right")
    rows = left.unionByName(right).join(uneven, PRINT_COLS).dropDuplicates(PRINT_COLS)
    return rows.select(*names, "n_left", "n_right")


def difference_count(left: DataFrame, right: DataFrame) -> int:
    """How many rows one table has more than the other, over both sides."""
    return differences(left, right).agg(F.coalesce(F.sum(F.abs(F.col("n_left") - F.col("n_right"))), F.lit(0))).first()[0]
