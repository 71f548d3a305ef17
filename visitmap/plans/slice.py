"""The scheduled run's customer slice: the window's rows, distinct, written once.

The slice gives the run an exact count of its keys, a join without customer
copies, and a plain small scan to build the runtime filter from. It is written in
few large files, so the number of partial filters that are merged, each as large as the
filter, follows the slice's bytes and not the table's files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.functions.window import DateWindow
from visitmap.operators.dedupe import dedupe
from visitmap.session import scratch_path
from visitmap.sources.tables import scan_customer


def write_slice(spark: SparkSession, cus: DataFrame | str, window: DateWindow) -> tuple[DataFrame, int]:
    """The window's distinct customer rows, read back, and their number.

    The window is applied to the slice again by ``build_visit_map``: Spark plans a
    runtime filter only over a filtered scan.
    """
    path = scratch_path(spark, "customer-slice")
    rows = dedupe(scan_customer(cus, window, spark))
    rows.hint("rebalance").write.parquet(path)
    back = spark.read.schema(rows.schema).parquet(path)
    return back, back.select(F.count("*")).first()[0]
