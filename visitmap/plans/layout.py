"""Messaging history laid out by conversation, so that a run joins it without shuffling it.

The scheduled run reads all of messaging for a few days of customers. Laid out once in buckets of
``conversation_id``, the history is deduped and joined where it lies: both need its rows clustered by the
conversation, which the buckets already are, and only the customer slice is shuffled, to the same buckets.

* **Buckets** hold distinct rows, sorted by conversation, with a Parquet bloom filter on it. So a row group has
  a short range of conversations: the slice's smallest and largest one, and the listed conversations of a
  small slice, are pushed into the scan and skip row groups. A bucket is written and deduped by one task, so their
  number follows from the rows: ``bucket_rows`` each.
* **Crowded conversations.** A bucket is one task and can't be split, so conversations with more than ``hot_rows``
  rows are kept in a second, plain table, which is joined the usual way (shuffled, skew split). A
  conversation may have rows in both: a join over a union is the union of the joins, and the rows are deduped
  afterwards. The same goes for the customer side: conversations with more slice rows than that are joined with their
  messaging rows apart.
* **Growth.** ``append`` adds rows to both tables. Rows that are there already do no harm, so an append that was cut
  off is run again. A bucket then holds at most ``hot_rows`` rows of a conversation for each append. An append of more than
  ``bucket_rows`` rows a bucket is written by several tasks a bucket. The number of buckets stays, so a layout that has
  outgrown it is told, and should be made anew; so should one whose rows vanish or change at the source.

Rows without a conversation never join and are left out. A layout of no rows is two empty tables.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.operators.dedupe import dedupe
from visitmap.operators.link import link
from visitmap.sources.tables import scan_messaging

KEY = "conversation_id"
LISTED_KEYS = 10_000        # conversations of a slice that are pushed one by one; above, their range alone
BROADCAST_BYTES = 32 << 20  # crowded conversations, as bytes of their ids
HOT_ROWS = 1_000_000
BUCKET_ROWS = 1_000_000     # rows that one task writes; about 400 MB of its memory
OUTGROWN = 4                # times as many rows in a bucket, after appends

log = logging.getLogger("visitmap")


@dataclass(frozen=True)
class SliceKeys:
    """What a run knows of its slice's conversations: their range, all of them if few, and the crowded ones."""

    low: object
    high: object
    listed: tuple | None
    crowded: tuple

    def within(self) -> Column:
        """Messaging rows that can join the slice."""
        if self.low is None:
            return F.lit(False)
        found = F.col(KEY).between(F.lit(self.low), F.lit(self.high))
        return found if self.listed is None else found & F.col(KEY).isin(list(self.listed))


def slice_keys(rows: DataFrame, hot_rows: int = HOT_ROWS, listed: int = LISTED_KEYS) -> SliceKeys:
    """The conversations of a written slice. Collected: at most ``listed`` keys, and a crowded one for each ``hot_rows`` rows."""
    each = rows.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count("*").alias("rows"))
    number, low, high, most = each.agg(F.count("*"), F.min(KEY), F.max(KEY), F.max("rows")).first()
    every = tuple(sorted(r[0] for r in each.select(KEY).collect())) if number <= listed else None
    crowded = tuple(sorted(r[0] for r in each.where(F.col("rows") > hot_rows).select(KEY).collect())) if (most or 0) > hot_rows else ()
    return SliceKeys(low, high, every, crowded)


@dataclass(frozen=True)
class MessagingLayout:
    """Tables ``name`` (buckets) and ``name``_hot, narrowed to ``keys`` when a slice is known."""

    name: str
    keys: SliceKeys | None = None

    @property
    def hot_name(self) -> str:
        return f"{self.name}_hot"

    def for_slice(self, rows: DataFrame, hot_rows: int = HOT_ROWS) -> MessagingLayout:
        """The layout narrowed to the conversations of ``rows``, if both write them in the same type."""
        spark = rows.sparkSession
        if rows.schema[KEY].dataType != spark.table(self.name).schema[KEY].dataType:
            return self
        return replace(self, keys=slice_keys(rows, hot_rows))

    def parts(self, spark: SparkSession) -> list[DataFrame]:
        """The buckets, and the crowded conversations if there are any."""
        found = [spark.table(self.name)]
        hot = spark.table(self.hot_name)
        if not hot.isEmpty():
            found.append(hot)
        return found if self.keys is None else [p.where(self.keys.within()) for p in found]


def _writer(rows: DataFrame, mode: str):
    return rows.write.format("parquet").mode(mode).option(f"parquet.bloom.filter.enabled#{KEY}", "true") \
        .option("parquet.bloom.filter.adaptive.enabled", "true")


def _split(rows: DataFrame, hot_rows: int, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame, int]:
    """``rows`` apart by whether their conversation is crowded: more than ``hot_rows`` rows here, or ``known``.

    And the number of rows whose conversation isn't crowded here.
    """
    each, crowded = rows.groupBy(KEY).agg(F.count("*").alias("rows")), F.col("rows") > hot_rows
    hot = each.where(crowded).select(KEY)
    octets = F.octet_length(F.col(KEY).cast("string"))
    calm, number, size = each.agg(F.sum(F.when(~crowded, F.col("rows"))), F.count_if(crowded), F.sum(F.when(crowded, octets))).first()
    if known is not None:
        hot = hot.union(known.select(KEY)).distinct()
        number, size = hot.agg(F.count("*"), F.sum(octets)).first()
    if not number:
        return rows, rows.limit(0), calm or 0
    # A plain join beyond the bound; the ids are measured, with some room for the rows around them.
    listed = F.broadcast(hot) if size + 64 * number <= BROADCAST_BYTES else hot
    return rows.join(listed, KEY, "left_anti"), rows.join(listed, KEY, "left_semi"), calm or 0


def _write(layout: MessagingLayout, cold: DataFrame, hot: DataFrame, buckets: int, mode: str, location: str | None = None, tasks: int = 1) -> None:
    columns = cold.columns
    crowded = _writer(dedupe(hot).hint("rebalance").sortWithinPartitions(KEY), mode)
    # Partitioned as the buckets are, or as a multiple of them: ``tasks`` files a bucket, and copies go without another shuffle.
    rest = _writer(cold.repartition(buckets * tasks, KEY).dropDuplicates().select(*columns), mode).bucketBy(buckets, KEY).sortBy(KEY)
    for writer, name, folder in ((crowded, layout.hot_name, "hot"), (rest, layout.name, "buckets")):
        if location is not None:
            writer = writer.option("path", f"{location.rstrip('/')}/{folder}")
        writer.saveAsTable(name)


def create_layout(spark: SparkSession, msg: DataFrame | str, name: str, location: str, buckets: int, hot_rows: int = HOT_ROWS,
                  bucket_rows: int = BUCKET_ROWS) -> MessagingLayout:
    """Lay messaging out as ``name`` under ``location``, in ``buckets`` or as many more as keep ``bucket_rows`` rows in each.

    Take at least as many as the session's shuffle partitions: Spark shuffles both sides of a join rather than go below that number.
    """
    layout = MessagingLayout(name)
    rows = scan_messaging(msg, None, spark).where(F.col(KEY).isNotNull())
    cold, hot, number = _split(rows, hot_rows)
    _write(layout, cold, hot, max(buckets, math.ceil(number / bucket_rows)), "error", location)
    return layout


def append_layout(spark: SparkSession, layout: MessagingLayout, msg: DataFrame | str, hot_rows: int = HOT_ROWS, bucket_rows: int = BUCKET_ROWS) -> None:
    """Add rows. Conversations known as crowded, or crowded among these, go to the second table."""
    rows = scan_messaging(msg, None, spark).where(F.col(KEY).isNotNull())
    cold, hot, number = _split(rows, hot_rows, spark.table(layout.hot_name).select(KEY).distinct())
    buckets = bucket_number(spark, layout)
    _write(layout, cold, hot, buckets, "append", tasks=max(1, math.ceil(number / (buckets * bucket_rows))))
    held = spark.table(layout.name).count()
    if held > OUTGROWN * buckets * bucket_rows:
        log.warning("%s holds %d rows in %d buckets, each of which one task reads: lay it out anew", layout.name, held, buckets)


def bucket_number(spark: SparkSession, layout: MessagingLayout) -> int:
    told = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": layout.name}).where("col_name = 'Num Buckets'")
    return int(told.first()["data_type"])


def link_layout(cus: DataFrame, layout: MessagingLayout, prededupe: bool = True) -> DataFrame:
    """``link`` with the laid-out messaging rows."""
    spark = cus.sparkSession
    width = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if bucket_number(spark, layout) < width:
        log.warning("%s has fewer buckets than the session has shuffle partitions (%d): Spark shuffles it for the join", layout.name, width)
    parts = layout.parts(spark)
    made = dedupe if prededupe else (lambda rows: rows)
    crowded = list(layout.keys.crowded) if layout.keys is not None else []
    if not crowded:
        return reduce(DataFrame.unionAll, [link(cus, made(p)) for p in parts])
    among = F.col(KEY).isin(crowded)
    linked = [link(cus.where(~among), made(p)) for p in parts]
    # Few conversations, found in the buckets by their row groups: joined by a shuffle that can be split.
    linked.append(link(cus.where(among), made(reduce(DataFrame.unionAll, [p.where(among) for p in parts]))))
    return reduce(DataFrame.unionAll, linked)
