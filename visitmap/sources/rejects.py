"""Rows whose text times mean no time: sorted out, kept in a reject table, counted.

A bad end date tells no window, so a row with one is rejected whatever the window. Rows
outside the window are not looked at further. Without text columns nothing is
rejected and nothing is read for it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.functions.timefns import parsed_wall_clock
from visitmap.functions.window import DateWindow
from visitmap.session import scratch_path

TIME_COLS = ["conversation_start_utc_ts", "conversation_end_utc_ts", "conversation_end_utc_date"]
WINDOW_COL = "conversation_end_utc_date"
REJECT_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("conversation_id", T.StringType()),
    T.StructField("column", T.StringType()), T.StructField("value", T.StringType()), T.StructField("run_date", T.DateType())])


def text_times(df: DataFrame, columns: list[str] = TIME_COLS) -> list[str]:
    """Those of the time columns that are text."""
    return [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]


def is_bad(column: str) -> Column:
    return F.col(column).isNotNull() & parsed_wall_clock(F.col(column)).isNull()


def told_bad(column: str) -> Column:
    """Whether a marked row's ``bad_times`` name ``column``."""
    return F.exists("bad_times", lambda x: x["column"] == column)


@dataclass
class Rejects:
    """A reject table: a row for each bad value of each run, in a folder partitioned by the run's date.

    A second run of the same date replaces that date's rows of its source. ``counts`` has, for
    each source of the last run, good and bad rows and the bad values of each column.
    """

    path: str
    counts: dict[str, dict[str, int]] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(REJECT_SCHEMA).parquet(self.path).where(F.col("column").isNotNull())

    def sort_out(self, df: DataFrame, source: str, window: DateWindow | None, columns: list[str] = TIME_COLS) -> DataFrame:
        """The rows of ``df`` in ``window`` with good times, as TIMESTAMP_NTZ of UTC; the others go to the table.

        The rows are read once: they are written to the scratch folder, good and bad apart.
        """
        spark, texts = df.sparkSession, text_times(df, columns)
        if not texts:
            self.counts[source] = {}
            return window.apply(df, WINDOW_COL) if window is not None else df
        if "bad_times" in df.columns:
            raise ValueError("a source has a column called bad_times")
        bad = F.filter(F.array(*[F.when(is_bad(c), F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))) for c in texts]), lambda x: x.isNotNull())
        marked = df.withColumn("bad_times", bad)
        parsed = marked.withColumns({c: parsed_wall_clock(F.col(c)) for c in texts})
        if window is not None:
            # Text compares as text in the other modes, as everywhere.
            compared = parsed if window.mode == "report_days" or WINDOW_COL not in texts else marked
            inside = window.predicate(F.col(WINDOW_COL), compared.schema[WINDOW_COL].dataType)
            kept = compared.where(told_bad(WINDOW_COL) | inside)
            parsed = kept if compared is parsed else kept.withColumns({c: parsed_wall_clock(F.col(c)) for c in texts})
        seen = Observation()
        bad_rows = F.size("bad_times") > 0
        each = [F.count(F.when(told_bad(c), 1)).alias(c) for c in texts]
        path = scratch_path(spark, f"sorted-{source}")
        split = parsed.withColumn("is_bad", bad_rows)
        (split.observe(seen, F.count(F.when(~bad_rows, 1)).alias("good"), F.count(F.when(bad_rows, 1)).alias("bad"), *each)
         .write.partitionBy("is_bad").parquet(path))
        self.counts[source] = dict(seen.get)
        back = spark.read.schema(split.schema).parquet(path)
        self._write(back.where("is_bad").select("conversation_id", F.explode("bad_times").alias("x")).select("conversation_id", "x.column", "x.value"),
                    source, window)
        return back.where("not is_bad").drop("is_bad", "bad_times")

    def _write(self, rows: DataFrame, source: str, window: DateWindow | None) -> None:
        run_date = F.lit(window.end) if window is not None else F.current_date()
        out = rows.withColumns({"source": F.lit(source), "run_date": run_date})
        # An empty partition would keep its old rows: a row that says there are none replaces them.
        none = rows.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in REJECT_SCHEMA if f.name not in ("source", "run_date")],
                                                 F.lit(source).alias("source"), run_date.alias("run_date"))
        (out.select(*REJECT_SCHEMA.names).unionByName(none.select(*REJECT_SCHEMA.names)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "source").parquet(self.path))
