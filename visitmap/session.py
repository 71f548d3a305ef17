"""Session settings and the shared scratch folder."""

from __future__ import annotations

import logging
import math
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.utils import is_remote

# Settings the job relies on at scale. AQE sizes shuffles from measured bytes
# (start wide, coalesce down), splits skewed join partitions and turns a join
# into a broadcast only when the measured side is small; static broadcasts
# from file-size estimates are off, since compressed file sizes do not bound
# the in-memory size of a filtered, projected side.
#
# The runtime bloom filter (windowed customer keys -> messaging scan) has two
# size gates in Spark: the creation side's *estimated* size (10 MB by default; a
# filtered scan without statistics is estimated at its whole table) and the size
# scanned on the application side (10 GB by default). Both would switch the
# filter off silently at some table size, so both are opened: the filter's own
# size is bounded, and the scheduled run builds it from a written slice of the
# window with few files (``plans.slice``), which bounds what its merge reads.
#
# The stage after the join explodes rows and aggregates them, so it is
# CPU-heavy for its shuffle input. AQE's 1 MB minimum partition size packs a
# small pruned shuffle into two or three tasks; 256 KB keeps it spread over the
# cores (14% faster over the headline queries at sf0.1) and never binds on
# large shuffles.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(2**63 - 1),
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1b",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
}


_HASHES = 5  # hash functions of a filter at 3% false positives

log = logging.getLogger("visitmap")


@contextmanager
def apply(spark: SparkSession, settings: dict[str, str], keep: Iterable[str] = ()) -> Iterator[None]:
    """Run a block under ``settings`` (but for the keys in ``keep``), then restore what was there."""
    mine = {k: v for k, v in settings.items() if k not in set(keep)}
    old = {k: spark.conf.get(k, None) for k in mine}
    try:
        for k, v in mine.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def bloom_filter_conf(expected_keys: int, fpp: float = 0.03, max_bytes: int = 64 << 20) -> dict[str, str]:
    """Runtime-filter sizing for ``expected_keys`` distinct customer keys in a window.

    Without statistics Spark sizes the filter for 1M keys (1 MiB), so it
    saturates on a large window and stops pruning. This sizes it for the
    expected keys at false-positive rate ``fpp`` (m = -n ln p / ln^2 2 bits),
    capped at ``max_bytes``: the filter is what gets broadcast, and its size
    stays this bound whatever the data.
    """
    n = max(1, int(expected_keys))
    bits = math.ceil(-n * math.log(fpp) / (math.log(2) ** 2))
    if bits > max_bytes * 8:
        bits = max_bytes * 8
        rate = (1 - math.exp(-n * _HASHES / bits)) ** _HASHES
        log.warning("the runtime filter's bound of %d MB binds for %d keys: about %.0f%% of other rows pass it", max_bytes >> 20, n, 100 * rate)
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    return {prefix + "expectedNumItems": str(n), prefix + "maxNumItems": str(n),
            prefix + "numBits": str(bits), prefix + "maxNumBits": str(bits)}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "visitmap",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off)."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("VISITMAP_DRIVER_MEMORY", "8g")))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session (tests) that names none gets a temporary folder set
    as its checkpoint dir. On a cluster a machine-local folder would not be
    shared by the executors, so a missing setting is an error.
    """
    if is_remote():  # a Spark Connect session has no SparkContext
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return root.rstrip("/")
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="visitmap-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused folder under the scratch root."""
    return f"{scratch_root(spark)}/visitmap/{name}-{uuid.uuid4().hex}"
