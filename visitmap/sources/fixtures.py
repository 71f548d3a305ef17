"""Derive the two messaging inputs from the driver's tables.

The driver ships TPC-H-like tables, not messaging tables, so the inputs are
declared as projections of them. Each is a plain Spark projection of a whole
table: it grows with the table and keeps filter pushdown and column pruning.

* customer messaging from ``orders``: one conversation per order; the three
  time columns are the order date (midnight values); the visit-id array is
  NULL, empty, or two ids (which can repeat).
* messaging from ``lineitem``: one row per line, so a conversation repeats.
* both again from ``events``, whose times carry a time of day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (see SURVEY 7.4): visit ids are NULL when
# o_orderkey % 7 = 0, empty when o_orderkey % 11 = 0, else
# ['v' + o_custkey % 13, 'v' + o_orderkey % 17]; account_id = l_suppkey % 5;
# device 'Desktop' when l_quantity > 25.
NULL_GUIDS_MOD = 7
EMPTY_GUIDS_MOD = 11
CUST_GUID_MOD = 13
ORDER_GUID_MOD = 17
ACCOUNT_MOD = 5
DESKTOP_MIN_QTY = 25
GUID_PREFIX = "v"
DEVICE_DESKTOP = "Desktop"
# Events mapping: 'error' events carry no visit ids; visit ids are the event
# type and 'u' + user_id % 3; account_id = user_id % 5; the source is the
# constant 'web'; device 'Desktop' when value > 25.
EVENTS_NO_GUIDS_TYPE = "error"
EVENTS_USER_GUID_MOD = 3
EVENTS_USER_PREFIX = "u"
EVENTS_SOURCE = "web"
EVENTS_DESKTOP_MIN_VALUE = 25



def _null_array() -> Column:
    return F.lit(None).cast("array<string>")


def _empty_array() -> Column:
    return F.array().cast("array<string>")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _guid(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def customer_messaging_from_orders(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    guids = (
        F.when(key % NULL_GUIDS_MOD == 0, _null_array())
        .when(key % EMPTY_GUIDS_MOD == 0, _empty_array())
        .otherwise(F.array(_guid(GUID_PREFIX, F.col("o_custkey") % CUST_GUID_MOD),
                           _guid(GUID_PREFIX, key % ORDER_GUID_MOD)))
    )
    return orders.select(
        key.cast("string").alias("conversation_id"),
        F.col("o_orderdate").alias("conversation_start_utc_ts"),
        F.col("o_orderdate").alias("conversation_end_utc_ts"),
        F.col("o_orderdate").alias("conversation_end_utc_date"),
        guids.alias("visit_guids"),
    )


def messaging_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("conversation_id"),
        (F.col("l_suppkey") % ACCOUNT_MOD).alias("account_id"),
        F.col("l_returnflag").alias("visitor_app_id"),
        F.col("l_linestatus").alias("conversation_source"),
        F.when(F.col("l_quantity") > DESKTOP_MIN_QTY, F.lit(DEVICE_DESKTOP)).alias("visitor_device_type"),
        F.col("l_shipdate").alias("conversation_end_utc_date"),
    )


def customer_messaging_from_events(events: DataFrame) -> DataFrame:
    guids = F.when(F.col("event_type") == EVENTS_NO_GUIDS_TYPE, _null_array()).otherwise(
        F.array(F.col("event_type"),
                _guid(EVENTS_USER_PREFIX, F.col("user_id") % EVENTS_USER_GUID_MOD)))
    return events.select(
        F.col("event_id").cast("string").alias("conversation_id"),
        F.col("ts").alias("conversation_start_utc_ts"),
        F.col("ts").alias("conversation_end_utc_ts"),
        F.col("ts").alias("conversation_end_utc_date"),
        guids.alias("visit_guids"),
    )


def messaging_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("conversation_id"),
        (F.col("user_id") % ACCOUNT_MOD).alias("account_id"),
        F.col("event_type").alias("visitor_app_id"),
        F.lit(EVENTS_SOURCE).alias("conversation_source"),
        F.when(F.col("value") > EVENTS_DESKTOP_MIN_VALUE, F.lit(DEVICE_DESKTOP)).alias("visitor_device_type"),
        F.col("ts").alias("conversation_end_utc_date"),
    )


def load_inputs(spark: SparkSession, sf_dir: str, kind: str = "orders") -> tuple[DataFrame, DataFrame]:
    """(customer messaging, messaging) derived from the driver tables in ``sf_dir``."""
    if kind == "orders":
        return (customer_messaging_from_orders(read_table(spark, sf_dir, "orders")),
                messaging_from_lineitem(read_table(spark, sf_dir, "lineitem")))
    if kind == "events":
        events = read_table(spark, sf_dir, "events")
        return customer_messaging_from_events(events), messaging_from_events(events)
    raise ValueError(f"unknown fixture kind {kind!r}")
