"""Scans of the two messaging inputs, and the driver-table fixtures."""

from visitmap.sources.fixtures import (
    customer_messaging_from_events,
    customer_messaging_from_orders,
    load_inputs,
    messaging_from_events,
    messaging_from_lineitem,
    read_table,
)
from visitmap.sources.tables import read_target, resolve, scan_customer, scan_messaging

__all__ = [
    "customer_messaging_from_events",
    "customer_messaging_from_orders",
    "load_inputs",
    "messaging_from_events",
    "messaging_from_lineitem",
    "read_table",
    "read_target",
    "resolve",
    "scan_customer",
    "scan_messaging",
]
