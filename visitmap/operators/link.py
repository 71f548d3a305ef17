"""Join the two messaging inputs and build the contact key.

The join is a plain inner equi-join with no hint: Catalyst adds the NOT NULL
filters on the key, AQE turns it into a broadcast join only when a side's
measured shuffle output is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
and splits a skewed key's partition across tasks otherwise. When the
customer side is filtered to a short window, the runtime bloom filter prunes
the messaging scan before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmap.functions.keys import contact_key
from visitmap.schemas import LINKED_COLS


def rename_app_id(msg: DataFrame) -> DataFrame:
    """Messaging columns under their output names (visitor_app_id -> app_id)."""
    return msg.withColumnRenamed("visitor_app_id", "app_id")


def link(cus: DataFrame, msg: DataFrame) -> DataFrame:
    """Inner join on ``conversation_id`` (USING form) + contact key + 8 columns.

    Unmatched and NULL-key rows drop on both sides; repeated keys multiply rows
    (the later dedupe removes rows equal on every kept column).
    """
    joined = cus.join(rename_app_id(msg), "conversation_id", "inner")
    return joined.select(
        contact_key(F.col("account_id"), F.col("conversation_id")).alias("parent_contact_id"),
        *LINKED_COLS[1:],
    )


def link_on(cus: DataFrame, msg: DataFrame) -> DataFrame:
    """The same join in ON form: both key columns stay visible.

    Output: ``cus_conversation_id``, ``msg_conversation_id`` and the linked
    columns.
    """
    c = cus.alias("c")
    m = rename_app_id(msg).alias("m")
    joined = c.join(m, F.col("c.conversation_id") == F.col("m.conversation_id"), "inner")
    return joined.select(
        F.col("c.conversation_id").alias("cus_conversation_id"),
        F.col("m.conversation_id").alias("msg_conversation_id"),
        contact_key(F.col("m.account_id"), F.col("c.conversation_id")).alias("parent_contact_id"),
        *[F.col(f"c.{n}") for n in ("conversation_start_utc_ts", "conversation_end_utc_ts",
                                    "conversation_end_utc_date", "visit_guids")],
        *[F.col(f"m.{n}") for n in ("app_id", "visitor_device_type", "conversation_source")],
    )
