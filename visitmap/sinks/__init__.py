"""Writers for the partitioned target and the ORC export (K1-K8)."""

from visitmap.sinks.compact import compact_dates, compact_table
from visitmap.sinks.drift import evolve_table, read_evolved
from visitmap.sinks.files import export_orc, overwrite_partitions
from visitmap.sinks.tables import (
    create_export_table,
    create_target_table,
    insert_overwrite_by_name,
    publish_export_table,
    replace_export_table,
)

__all__ = [
    "compact_dates",
    "compact_table",
    "create_export_table",
    "create_target_table",
    "evolve_table",
    "export_orc",
    "insert_overwrite_by_name",
    "overwrite_partitions",
    "publish_export_table",
    "read_evolved",
    "replace_export_table",
]
