"""DataFrame -> DataFrame steps of the visit map."""

from visitmap.operators.compare import difference_count, differences
from visitmap.operators.dedupe import dedupe, distinct_sql, group_by_all_sql, register_view
from visitmap.operators.explode import explode_ids
from visitmap.operators.link import link, link_on, rename_app_id
from visitmap.operators.project import conform, project_contract
from visitmap.operators.stamp import add_build_stamp, add_query_clock, add_report_date, overwrite_with_build_time

__all__ = [
    "add_build_stamp",
    "add_query_clock",
    "add_report_date",
    "conform",
    "dedupe",
    "difference_count",
    "differences",
    "distinct_sql",
    "explode_ids",
    "group_by_all_sql",
    "link",
    "link_on",
    "overwrite_with_build_time",
    "register_view",
    "rename_app_id",
    "project_contract",
]
