"""Input shapes and the output contract of the visit map."""

# The column names and their order below are the tables' contract.

from pyspark.sql import types as T

# Customer messaging (source 1): one row per conversation and its visit ids.
CUSTOMER_COLS = [
    "conversation_id",
    "conversation_start_utc_ts",
    "conversation_end_utc_ts",
    "conversation_end_utc_date",
    "visit_guids",
]

# Messaging (source 2): conversation attributes.
MESSAGING_COLS = [
    "conversation_id",
    "account_id",
    "visitor_app_id",
    "conversation_source",
    "visitor_device_type",
]

# Output of the link step (join + contact key), in the order the tests use.
LINKED_COLS = [
    "parent_contact_id",
    "conversation_start_utc_ts",
    "conversation_end_utc_ts",
    "conversation_end_utc_date",
    "visit_guids",
    "app_id",
    "visitor_device_type",
    "conversation_source",
]

# Columns that identify an exploded row; the dedupe key.
EXPLODED_COLS = [
    "parent_contact_id",
    "conversation_start_utc_ts",
    "conversation_end_utc_ts",
    "conversation_end_utc_date",
    "app_id",
    "conversation_source",
    "visitor_device_type",
    "visit_guid",
]

# Output contract, in order.
STAMP_COL = "etl_build_mst_ts"
OUTPUT_COLS = EXPLODED_COLS + [STAMP_COL, "rpt_mst_date"]

PARTITION_COL = "rpt_mst_date"


def customer_schema(time_type: T.DataType = T.TimestampType()) -> T.StructType:
    return T.StructType(
        [
            T.StructField("conversation_id", T.StringType(), True),
            T.StructField("conversation_start_utc_ts", time_type, True),
            T.StructField("conversation_end_utc_ts", time_type, True),
            T.StructField("conversation_end_utc_date", time_type, True),
            T.StructField("visit_guids", T.ArrayType(T.StringType(), True), True),
        ]
    )


def messaging_schema(time_type: T.DataType = T.TimestampType()) -> T.StructType:
    return T.StructType(
        [
            T.StructField("conversation_id", T.StringType(), True),
            T.StructField("account_id", T.IntegerType(), True),
            T.StructField("visitor_app_id", T.StringType(), True),
            T.StructField("conversation_source", T.StringType(), True),
            T.StructField("visitor_device_type", T.StringType(), True),
            T.StructField("conversation_end_utc_date", time_type, True),
        ]
    )


def output_schema(time_type: T.DataType = T.TimestampType()) -> T.StructType:
    """Target table contract (Parquet, partitioned by ``rpt_mst_date``)."""
    return T.StructType(
        [
            T.StructField("parent_contact_id", T.StringType(), True),
            T.StructField("conversation_start_utc_ts", time_type, True),
            T.StructField("conversation_end_utc_ts", time_type, True),
            T.StructField("conversation_end_utc_date", time_type, True),
            T.StructField("app_id", T.StringType(), True),
            T.StructField("conversation_source", T.StringType(), True),
            T.StructField("visitor_device_type", T.StringType(), True),
            T.StructField("visit_guid", T.StringType(), True),
            T.StructField("etl_build_mst_ts", time_type, True),
            T.StructField("rpt_mst_date", T.DateType(), True),
        ]
    )


def export_schema(time_type: T.DataType = T.TimestampType()) -> T.StructType:
    """Export copy contract (ORC, unpartitioned, report date as text)."""
    fields = output_schema(time_type).fields[:-1]
    return T.StructType(fields + [T.StructField("rpt_mst_date", T.StringType(), True)])
