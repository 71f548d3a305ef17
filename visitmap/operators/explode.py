"""One row per visit id (A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_ids(df: DataFrame, array_col: str = "visit_guids", out_col: str = "visit_guid") -> DataFrame:
    """Replace the array column by one row per element, in place.

    ``explode_outer`` keeps conversations without ids: a NULL or empty array
    gives one row with a NULL id; NULL and repeated elements give rows of
    their own (a later dedupe removes the repeats). Elements are not trimmed.
    """
    cols = [F.explode_outer(F.col(array_col)).alias(out_col) if c == array_col else F.col(c)
            for c in df.columns]
    return df.select(*cols)
