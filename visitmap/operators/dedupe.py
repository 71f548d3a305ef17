"""Whole-row dedupe (A1-A4).

NULLs compare equal and arrays compare by value and order. Spark plans a
dedupe as a partial hash aggregate before the shuffle (map-side combine) and a
final one after it, so copies of one row collapse before they move: a group
of copies holding a third of all rows costs one row per map task on the wire.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def dedupe(df: DataFrame) -> DataFrame:
    """Rows distinct on every column."""
    return df.dropDuplicates()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def distinct_sql(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``SELECT DISTINCT <cols> ... GROUP BY <cols>`` over ``df``.

    The SQL shape of the original script (a redundant DISTINCT over a GROUP BY
    with no aggregate); Catalyst plans both as one aggregate.
    """
    cols = ", ".join(_quoted(c) for c in df.columns)
    return spark.sql(f"SELECT DISTINCT {cols} FROM {{src}} GROUP BY {cols}", src=df)


def register_view(df: DataFrame, name: str | None = None) -> str:
    """Register ``df`` as a temp view; returns its (by default unique) name."""
    name = name or f"visitmap_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


def group_by_all_sql(spark: SparkSession, df: DataFrame, view: str | None = None) -> DataFrame:
    """``SELECT * FROM <view> GROUP BY <every column>`` through a temp view.

    A named ``view`` stays registered; an auto-named one is dropped once the
    statement is analysed (the result already holds the resolved plan).
    """
    name = register_view(df, view)
    cols = ", ".join(_quoted(c) for c in df.columns)
    out = spark.sql(f"SELECT * FROM IDENTIFIER(:view) GROUP BY {cols}", args={"view": name})
    if view is None:
        spark.catalog.dropTempView(name)
    return out
