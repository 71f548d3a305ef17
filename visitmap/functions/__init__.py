"""Column-level building blocks: date windows, report dates, stamps, keys."""

from visitmap.functions.keys import contact_key
from visitmap.functions.timefns import (
    build_stamp_literal,
    mst_now,
    report_date,
)
from visitmap.functions.window import DateWindow

__all__ = ["DateWindow", "build_stamp_literal", "contact_key", "mst_now", "report_date"]
