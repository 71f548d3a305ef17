"""Report date and build stamp at the fixed "MST" offset.

Every expression here gives the same answer under any session time zone:
wall-clock (TIMESTAMP_NTZ / text) inputs are shifted by a fixed interval, and
instants (TIMESTAMP) go through epoch seconds, never through the session zone.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values: "MST" is a fixed UTC-07:00 offset all year (no daylight saving);
# build-stamp text keeps millisecond precision.
MST_OFFSET_HOURS = -7
STAMP_FORMAT = "%Y-%m-%d %H:%M:%S.%f"
STAMP_DIGITS_CUT = 3

MST = timezone(timedelta(hours=MST_OFFSET_HOURS))
_OFFSET_SECONDS = MST_OFFSET_HOURS * 3600
_SECONDS_PER_DAY = 86400


def _shift_interval() -> Column:
    return F.make_dt_interval(hours=F.lit(-MST_OFFSET_HOURS))


# Text that names its own zone: Z, UTC, an offset, or a region at the end.
_ZONED_TEXT = r"(Z|UTC|GMT|[+-][0-9]{1,2}:[0-9]{2}|[A-Za-z]+/[A-Za-z_/]+)\s*$"
_EPOCH = "1970-01-01 00:00:00"


def instant_wall_clock(col: Column, zone_hours: int = 0) -> Column:
    """The wall clock (TIMESTAMP_NTZ) that an instant shows at a fixed offset, without the session zone."""
    micros = F.unix_micros(col) + F.lit(zone_hours * 3600 * 1_000_000)
    days = F.floor(micros / F.lit(_SECONDS_PER_DAY * 1_000_000)).cast("int")
    rest = ((micros - days.cast("long") * F.lit(_SECONDS_PER_DAY * 1_000_000)).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), rest)


def wall_clock_instant(col: Column, zone_hours: int = 0) -> Column:
    """The instant at which a wall clock (TIMESTAMP_NTZ) at a fixed offset shows ``col``."""
    part = lambda name: F.extract(F.lit(name), col)
    zone = F.lit(f"{'-' if zone_hours < 0 else '+'}{abs(zone_hours):02d}:00")
    return F.make_timestamp_ltz(part("YEAR"), part("MONTH"), part("DAY"), part("HOUR"), part("MINUTE"), part("SECOND"), zone)


def parsed_wall_clock(text: Column) -> Column:
    """The UTC wall clock that a text means: as it stands, or converted from the zone that it names. Null if it means none."""
    zoned = text.rlike(_ZONED_TEXT)
    return F.when(zoned, instant_wall_clock(F.when(zoned, text).try_cast("timestamp"))).otherwise(F.when(~zoned, text).try_cast("timestamp_ntz"))


def utc_wall_clock(text: Column) -> Column:
    """``parsed_wall_clock``, where text that means no time is an error that shows it (``sources.rejects`` sorts it out before)."""
    parsed = parsed_wall_clock(text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(F.concat(F.lit("not a time: "), text))).otherwise(parsed)


def convert_time(col: Column, have: T.DataType, want: T.DataType, zone_hours: int = 0) -> Column:
    """``col`` as another type; between wall clocks (text too) and instants by the given offset."""
    if isinstance(have, T.StringType) and isinstance(want, T.TimestampNTZType):
        return utc_wall_clock(col)
    if isinstance(have, T.StringType) and isinstance(want, T.TimestampType):
        return wall_clock_instant(utc_wall_clock(col), zone_hours)
    if isinstance(have, T.TimestampNTZType) and isinstance(want, T.TimestampType):
        return wall_clock_instant(col, zone_hours)
    if isinstance(have, T.TimestampType) and isinstance(want, T.TimestampNTZType):
        return instant_wall_clock(col, zone_hours)
    if isinstance(have, T.DateType) and isinstance(want, (T.TimestampType, T.TimestampNTZType)):
        return convert_time(col.cast("timestamp_ntz"), T.TimestampNTZType(), want, zone_hours) if isinstance(want, T.TimestampType) else col.cast(want)
    return col.cast(want)


def report_date(col: Column, data_type: T.DataType) -> Column:
    """MST calendar date of a UTC time value, as DATE.

    * TIMESTAMP_NTZ / text: the value is a UTC wall clock; subtract 7 hours. Text
      that names its own zone is converted to UTC first.
    * TIMESTAMP (an instant): floor((epoch seconds - 7h) / 1 day) as a day number.
    * DATE: midnight UTC, which is the previous MST day.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return F.to_date(col - _shift_interval())
    if isinstance(data_type, T.TimestampType):
        days = F.floor((F.unix_seconds(col) + F.lit(_OFFSET_SECONDS)) / F.lit(_SECONDS_PER_DAY))
        return F.date_from_unix_date(days.cast("int"))
    if isinstance(data_type, T.StringType):
        return F.to_date(utc_wall_clock(col) - _shift_interval())
    if isinstance(data_type, T.DateType):
        return F.date_sub(col, 1)
    raise TypeError(f"report date needs a date, timestamp or text column, not {data_type}")


def mst_now() -> datetime:
    """Driver clock as a naive MST wall clock, cut to milliseconds."""
    return stamp_wall_clock(datetime.now(MST))


def stamp_wall_clock(build_ts: datetime | date | str) -> datetime:
    """Normalise a build time to a naive MST wall clock with ms precision.

    Aware datetimes are converted to MST; naive ones and text are taken as MST
    wall clocks already.
    """
    if isinstance(build_ts, str):
        build_ts = datetime.fromisoformat(build_ts)
    elif not isinstance(build_ts, datetime):
        build_ts = datetime(build_ts.year, build_ts.month, build_ts.day)
    if build_ts.tzinfo is not None:
        build_ts = build_ts.astimezone(MST).replace(tzinfo=None)
    return build_ts.replace(microsecond=build_ts.microsecond // 1000 * 1000)


def stamp_text(build_ts: datetime | date | str) -> str:
    return stamp_wall_clock(build_ts).strftime(STAMP_FORMAT)[:-STAMP_DIGITS_CUT]


def build_stamp_literal(build_ts: datetime | date | str | None, data_type: T.DataType) -> Column:
    """One literal per run: the build time as TIMESTAMP_NTZ (MST wall clock)
    or as TIMESTAMP (the instant). Being a constant it cannot change a dedupe.
    """
    wall = stamp_wall_clock(build_ts) if build_ts is not None else mst_now()
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(stamp_text(wall)).cast("timestamp_ntz")
    instant = wall.replace(tzinfo=MST).astimezone(timezone.utc)
    return F.lit(instant).cast("timestamp")
