"""Date windows over the conversation end date (rolling, backfill, fixed).

Bounds become typed literals of the filtered column's own type, so Catalyst
folds them and Parquet gets them as pushed filters; nothing is spliced into SQL
text.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmap.functions.timefns import MST, MST_OFFSET_HOURS, utc_wall_clock

# The rolling window ends yesterday (MST) and looks back 10 more
# days; a history backfill starts on 2016-01-01.
DEFAULT_LOOKBACK_DAYS = 10
HISTORY_START = date(2016, 1, 1)

_REPORT_DAY_START = time(-MST_OFFSET_HOURS, 0)  # 07:00 UTC starts an MST day


def _as_date(d: date | str) -> date:
    if isinstance(d, datetime):
        return d.date()
    if isinstance(d, date):
        return d
    return date.fromisoformat(d)


def _mst_today() -> date:
    return datetime.now(MST).date()


@dataclass(frozen=True)
class DateWindow:
    """An inclusive window of calendar days ``[start, end]``.

    ``mode`` chooses how the last day is read on a time column:

    * ``"closed"``: ``start <= x <= end`` with the bounds at midnight UTC, as
      the original job compares. On a TIMESTAMP the last day keeps only
      its first instant.
    * ``"whole_days"``: UTC days, half open ``[start, end + 1 day)``.
    * ``"report_days"``: MST report days, ``[start 07:00Z, end + 1 day 07:00Z)``.
      Every report date in the window is complete, so overwriting its
      partition loses nothing (see ``plans.rerun``).
    """

    start: date
    end: date
    mode: str = "closed"

    def __post_init__(self):
        object.__setattr__(self, "start", _as_date(self.start))
        object.__setattr__(self, "end", _as_date(self.end))
        if self.mode not in ("closed", "whole_days", "report_days"):
            raise ValueError(f"unknown window mode {self.mode!r}")
        if self.end < self.start:
            raise ValueError(f"window ends before it starts: {self.start} > {self.end}")

    # ---- constructors (F3, F4) -------------------------------------------------
    @classmethod
    def rolling(cls, as_of: date | str | None = None, lookback_days: int = DEFAULT_LOOKBACK_DAYS,
                mode: str = "closed") -> "DateWindow":
        """end = (MST today or ``as_of``) - 1 day, start = end - ``lookback_days``."""
        today = _as_date(as_of) if as_of is not None else _mst_today()
        end = today - timedelta(days=1)
        return cls(end - timedelta(days=lookback_days), end, mode)

    @classmethod
    def backfill(cls, as_of: date | str | None = None, start: date | str = HISTORY_START,
                 mode: str = "closed") -> "DateWindow":
        """History run: from ``start`` up to yesterday (MST) or ``as_of`` - 1."""
        today = _as_date(as_of) if as_of is not None else _mst_today()
        return cls(_as_date(start), today - timedelta(days=1), mode)

    def with_mode(self, mode: str) -> "DateWindow":
        return replace(self, mode=mode)

    def report_dates(self) -> list[date]:
        """Report dates a ``report_days`` window fills completely."""
        n = (self.end - self.start).days + 1
        return [self.start + timedelta(days=i) for i in range(n)]

    # ---- predicates (F1, F2, F5) -------------------------------------------------
    def _bounds(self) -> tuple[datetime, datetime, bool]:
        """(low, high, high_inclusive) as naive UTC wall clocks."""
        if self.mode == "closed":
            return datetime.combine(self.start, time()), datetime.combine(self.end, time()), True
        if self.mode == "whole_days":
            return (datetime.combine(self.start, time()),
                    datetime.combine(self.end + timedelta(days=1), time()), False)
        return (datetime.combine(self.start, _REPORT_DAY_START),
                datetime.combine(self.end + timedelta(days=1), _REPORT_DAY_START), False)

    def predicate(self, col: Column, data_type: T.DataType) -> Column:
        lo, hi, hi_closed = self._bounds()
        if isinstance(data_type, T.DateType):
            # A DATE is midnight UTC: compare whole days that fall in [lo, hi].
            first = lo.date() if lo.time() == time() else lo.date() + timedelta(days=1)
            last = hi.date() if (hi_closed or hi.time() != time()) else hi.date() - timedelta(days=1)
            return (col >= F.lit(first)) & (col <= F.lit(last))
        if isinstance(data_type, T.TimestampNTZType):
            lo_c = F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz")
            hi_c = F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz")
        elif isinstance(data_type, T.TimestampType):
            lo_c = F.lit(lo.replace(tzinfo=timezone.utc)).cast("timestamp")
            hi_c = F.lit(hi.replace(tzinfo=timezone.utc)).cast("timestamp")
        elif isinstance(data_type, T.StringType):
            if self.mode == "report_days":
                col = utc_wall_clock(col)  # as the report date reads it, so both put a row into the same day
                lo_c = F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz")
                hi_c = F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz")
            else:
                # Text compares as text, like the original job's spliced literals.
                lo_c = F.lit(lo.date().isoformat())
                hi_c = F.lit(hi.date().isoformat())
        else:
            raise TypeError(f"cannot window a column of type {data_type}")
        upper = col <= hi_c if hi_closed else col < hi_c
        return (col >= lo_c) & upper

    def apply(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` filtered to the window on ``column``."""
        return df.where(self.predicate(F.col(column), df.schema[column].dataType))
