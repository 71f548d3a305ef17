"""Composite contact key."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def contact_key(account_id: Column, conversation_id: Column) -> Column:
    """``<account_id>-<conversation_id>``; NULL if either part is NULL.

    ``concat`` (not ``concat_ws``) on purpose: a missing account must not turn
    into a key that looks valid.
    """
    return F.concat(account_id.cast("string"), F.lit("-"), conversation_id)
