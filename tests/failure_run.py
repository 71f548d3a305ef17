"""Run by tests/test_failure.py in its own JVM (task retries need their own master)."""

import os
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from visitmap import DateWindow, build_visit_map  # noqa: E402
from visitmap.sinks import overwrite_partitions  # noqa: E402
from visitmap.sources import load_inputs  # noqa: E402


def failing_check(marker: str):
    """True for every row, but the first task to evaluate it dies once (mid-task)."""

    @F.udf(T.BooleanType())
    def fail_once(_):
        if TaskContext.get().attemptNumber() == 0:
            try:
                os.close(os.open(marker, os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                return True
            raise RuntimeError("injected task failure")
        return True

    # Nondeterministic: Catalyst keeps it where it is written, after the join and
    # the dedupe, in a reduce stage whose retry re-reads shuffle output.
    return fail_once.asNondeterministic()


def main(sf_dir, target, checkpoint, marker):
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.setCheckpointDir(checkpoint)
    cus, msg = load_inputs(spark, sf_dir)
    df = build_visit_map(cus, msg, DateWindow("1997-01-01", "1997-12-31", "report_days"), build_ts="2024-02-01")
    expected = df.count()
    overwrite_partitions(df.where(failing_check(marker)(F.col("parent_contact_id"))), target)
    back = spark.read.parquet(target)
    print(f"RESULT expected={expected} written={back.count()} distinct={back.distinct().count()}")


if __name__ == "__main__":
    main(*sys.argv[1:])
