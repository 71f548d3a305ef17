"""The visit map in SQL statements, as a SQL user would write it.

Same answer as ``build_visit_map``; the inputs are bound as DataFrames
(``{cus}``, ``{msg}``) and table names with ``IDENTIFIER``, never spliced text.
The window is applied to the customer DataFrame before the SQL, as a typed
predicate, and Catalyst pushes it into the scan just the same.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from visitmap.functions.window import DateWindow
from visitmap.operators.project import project_contract
from visitmap.operators.stamp import add_build_stamp, add_report_date
from visitmap.sources.tables import scan_customer, scan_messaging

_VISIT_ROWS = """
WITH m AS (
    SELECT DISTINCT conversation_id, account_id, visitor_app_id, conversation_source, visitor_device_type
    FROM {msg}
),
linked AS (
    SELECT concat(CAST(m.account_id AS STRING), '-', c.conversation_id) AS parent_contact_id,
           c.conversation_start_utc_ts, c.conversation_end_utc_ts, c.conversation_end_utc_date, c.visit_guids,
           m.visitor_app_id AS app_id, m.conversation_source, m.visitor_device_type
    FROM {cus} AS c
    JOIN m ON m.conversation_id = c.conversation_id
)
SELECT parent_contact_id, conversation_start_utc_ts, conversation_end_utc_ts, conversation_end_utc_date,
       app_id, conversation_source, visitor_device_type, visit_guid
FROM linked LATERAL VIEW OUTER explode(visit_guids) ids AS visit_guid
GROUP BY ALL
"""


def build_visit_map_sql(
    spark: SparkSession,
    cus: DataFrame | str,
    msg: DataFrame | str,
    window: DateWindow | None = None,
    *,
    build_ts: datetime | date | str | None = None,
) -> DataFrame:
    """The scheduled job (customer-side window) as one SQL statement.

    The same plan as ``build_visit_map``: messaging deduped before the join
    (the DISTINCT subquery), explode keeping conversations without ids, and
    a single GROUP BY over every output column after the explode.
    """
    rows = spark.sql(_VISIT_ROWS, cus=scan_customer(cus, window, spark), msg=scan_messaging(msg, None, spark))
    return project_contract(add_build_stamp(add_report_date(rows), build_ts))
