"""Visit map: link customer messaging conversations to the web visits behind them.

Every public function is a lazy ``DataFrame -> DataFrame`` step (or a sink that
performs one Spark write). Nothing collects rows to the driver.
"""

from visitmap.functions.window import DateWindow
from visitmap.plans.visit_map import build_visit_map

__all__ = ["DateWindow", "build_visit_map"]
