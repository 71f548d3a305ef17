"""Date prints: what a target's report dates hold, so that a rerun writes only dates that have changed.

A date's print is the number of its rows and the sums of their hashes, without the build
stamp: the same in any order, and mergeable. Prints stand in a folder of their own, one small
partition a date. A date's print is removed before the date is written and stored
afterwards, so a run that is cut off leaves a date without a print, never with a wrong one.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.functions.prints import PRINT_COLS, add_prints, print_sums
from visitmap.schemas import EXPLODED_COLS, PARTITION_COL
from visitmap.sinks.files import drop_dates, stored_dates

_SUM = T.DecimalType(38, 0)
SCHEMA = T.StructType([T.StructField("n", T.LongType()), *[T.StructField(f"sum_{c}", _SUM) for c in PRINT_COLS],
                       T.StructField(PARTITION_COL, T.DateType())])


def date_prints(rows: DataFrame) -> DataFrame:
    """A row for each report date of ``rows`` (which have the contract's columns): count and sums."""
    sums = add_prints(rows, EXPLODED_COLS).groupBy(PARTITION_COL).agg(*print_sums())
    return sums.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMA])


@dataclass
class DatePrints:
    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        if not stored_dates(spark, self.path):
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).parquet(self.path)

    def changed(self, rows: DataFrame) -> list[date]:
        """The dates of ``rows`` whose print isn't the stored one: a list as long as the run's dates."""
        new, old = date_prints(rows), self.read(rows.sparkSession)
        return sorted(r[PARTITION_COL] for r in new.subtract(old).collect() if r[PARTITION_COL] is not None)

    def forget(self, spark: SparkSession, dates: list[date]) -> None:
        drop_dates(spark, self.path, dates)

    def store(self, rows: DataFrame) -> None:
        """Keep the prints of all dates of ``rows``."""
        (date_prints(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COL).parquet(self.path))
