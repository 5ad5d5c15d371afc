"""Time helpers on epoch-second columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _local(ts: Column, tz: str) -> Column:
    """Wall-clock time (without zone) of an epoch-seconds value in ``tz``."""
    utc = F.timestamp_add("SECOND", F.floor(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def hour_of_day(ts: Column, tz: str | None = None) -> Column:
    """Hour (0-23) of an epoch-seconds value, in ``tz`` or by default in the session
    time zone, like from_unixtime(ts, 'HH'). "UTC" is computed arithmetically."""
    secs = F.floor(ts)
    if tz is None:
        return F.hour(F.timestamp_seconds(secs))
    if tz == "UTC":
        return F.floor(F.pmod(secs, F.lit(86400)) / F.lit(3600)).cast("int")
    return F.hour(_local(ts, tz))


def day_string(ts: Column, fmt: str = "yyyy-MM-dd", tz: str | None = None) -> Column:
    """Calendar day of an epoch-seconds value, in ``tz`` or by default in the
    session time zone, like from_unixtime(ts, fmt)."""
    if tz is None:
        return F.from_unixtime(F.floor(ts), fmt)
    if tz == "UTC":
        return F.date_format(F.date_from_unix_date(F.floor(ts / F.lit(86400)).cast("int")), fmt)
    return F.date_format(_local(ts, tz), fmt)


def utc_day_key(ts: Column) -> Column:
    """yyyyMMdd partition value of an epoch-seconds value, always in UTC."""
    return F.date_format(F.date_from_unix_date(F.floor(ts / F.lit(86400)).cast("int")), "yyyyMMdd")


def epoch_seconds(datetime_col: Column, fmt: str = "yyyy-MM-dd HH:mm:ss", tz: str | None = None) -> Column:
    """Datetime text of ``tz`` (default: the session zone) to epoch seconds."""
    if tz is None:
        return F.unix_timestamp(datetime_col, fmt)
    local = F.to_timestamp_ntz(datetime_col, F.lit(fmt))
    utc = local if tz == "UTC" else F.convert_timezone(F.lit(tz), F.lit("UTC"), local)
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), utc)


def day_keys(start_day: str, last_day: str) -> Column:
    """Array of yyyyMMdd strings from start_day to last_day inclusive (yyyy-MM-dd input)."""
    days = F.sequence(F.to_date(F.lit(start_day)), F.to_date(F.lit(last_day)),
                      F.expr("interval 1 day"))
    return F.transform(days, lambda d: F.date_format(d, "yyyyMMdd"))
