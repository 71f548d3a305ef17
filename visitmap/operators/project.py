"""Output projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.functions.timefns import MST_OFFSET_HOURS, convert_time
from visitmap.schemas import STAMP_COL, output_schema


def project_contract(df: DataFrame) -> DataFrame:
    """The 10 output columns in contract order and with the contract's types.

    Times keep the build stamp's type (it follows the inputs; text becomes
    TIMESTAMP). Text is a UTC wall clock unless it names its own zone.
    """
    return conform(df, output_schema(df.schema[STAMP_COL].dataType), extra="drop")


def conform(df: DataFrame, target: T.StructType | list[str], extra: str = "refuse") -> DataFrame:
    """Columns of ``df`` in the target's order, matched by name (never position).

    With a StructType target, a column whose type differs is cast to the
    target type. Wall clocks and instants are converted by an explicit zone (MST
    for the build stamp, UTC for all other times), never the session's. A missing column is an
    error, not a silent NULL; so is an extra one, unless ``extra`` is "drop".
    """
    names = target.names if isinstance(target, T.StructType) else list(target)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the target: {missing}")
    more = [n for n in df.columns if n not in names]
    if more and extra != "drop":
        raise ValueError(f"columns the target doesn't have: {more}")
    if not isinstance(target, T.StructType):
        return df.select(*names)
    cols = []
    for field in target.fields:
        have = df.schema[field.name].dataType
        c = F.col(field.name)
        zone_hours = MST_OFFSET_HOURS if field.name == STAMP_COL else 0
        cols.append(c if have == field.dataType else convert_time(c, have, field.dataType, zone_hours).alias(field.name))
    return df.select(*cols)
