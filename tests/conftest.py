import os
import sys
from pathlib import Path

import pytest

# pyspark.testing imports pandas-on-Spark, which asks for this before a context starts.
os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from visitmap.session import RECOMMENDED_CONF

    builder = (SparkSession.builder.master("local[*]").appName("visitmap-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    sc = session.sparkContext
    if not (sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)):
        sc.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session


@pytest.fixture
def zone(spark):
    """Run a block under another session time zone, then restore it."""
    from contextlib import contextmanager

    @contextmanager
    def _zone(tz):
        old = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", tz)
        try:
            yield
        finally:
            spark.conf.set("spark.sql.session.timeZone", old)

    return _zone
