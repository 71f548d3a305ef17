"""Whole-job plans: the visit map and its windowed reruns."""

from visitmap.plans.layout import MessagingLayout, append_layout, create_layout
from visitmap.plans.rerun import backfill_run, run_window, rolling_run
from visitmap.plans.visit_map import build_visit_map, scheduled_visit_map
from visitmap.plans.visit_map_sql import build_visit_map_sql

__all__ = ["MessagingLayout", "append_layout", "backfill_run", "build_visit_map", "build_visit_map_sql", "create_layout",
           "rolling_run", "run_window", "scheduled_visit_map"]
