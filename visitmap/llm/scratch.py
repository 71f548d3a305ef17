"""Tables that the operators write for themselves, and their removal once nothing reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitmap.session import scratch_path as fresh_path

_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared scratch folder, remembered."""
    path = fresh_path(spark, name)
    _made.append(path)
    return path


def _drop(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _made.remove(path)


def _read_by(table: DataFrame) -> list[str]:
    files = table.inputFiles()
    return [p for p in _made if any(p.rsplit("/", 1)[-1] in f for f in files)]


def drop_table(spark: SparkSession, table: DataFrame) -> None:
    """Remove the scratch tables that ``table`` reads; no later step may read them."""
    _drop(spark, _read_by(table))


def tables() -> list[str]:
    """The folders written by this process and not removed."""
    return list(_made)


def drop_unread(spark: SparkSession, paths: list[str], docs: DataFrame) -> None:
    """Remove those of ``paths`` that are still there and that ``docs`` doesn't read."""
    kept = _read_by(docs)
    _drop(spark, [p for p in paths if p in _made and p not in kept])
