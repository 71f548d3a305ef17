"""A bounded, repeatable sample, for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def smallest_hashes(rows: DataFrame, hash_column: str, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest values of an even 64-bit hash.

    Rows are first cut at the value under which four times as many are expected, so
    that the tasks send few rows to the final choice however many tasks there are.
    """
    share = min(1.0, 4.0 * most / max(1, rows.count()))
    even = F.pmod(F.col(hash_column), F.lit(1 << 31))
    near = rows.where(even < F.lit(int(share * (1 << 31)))) if share < 1 else rows
    order = [even, F.col(hash_column), *[F.col(c) for c in rows.columns if c != hash_column]]
    return near.orderBy(*order).limit(most)
