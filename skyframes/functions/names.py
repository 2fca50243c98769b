"""File-name grammar ``<device>_MM-DD-YYYY_HH-MM-SS.jpg`` and time arithmetic that needs no session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed pattern of the time part of a file name
TIME_IN_NAME = r"(\d{2})-(\d{2})-(\d{2})\.[^.]+$"


def _two(value: Column) -> Column:
    return F.lpad(value.cast("string"), 2, "0")


def _date(seconds: Column) -> Column:
    return F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))


def _time(seconds: Column, parts: int) -> Column:
    tod = F.pmod(seconds, F.lit(86400))
    fields = [F.floor(tod / 3600), F.floor(tod / 60) % 60, tod % 60][:parts]
    return F.concat_ws("-", *[_two(f) for f in fields])


def _month_day(seconds: Column) -> Column:
    return F.concat_ws("-", _two(F.month(_date(seconds))), _two(F.day(_date(seconds))))


def frame_name(device: Column, local_seconds: Column) -> Column:
    """Landing name of a frame taken at a local time."""
    date = F.concat_ws("-", _month_day(local_seconds), F.lpad(F.year(_date(local_seconds)).cast("string"), 4, "0"))
    return F.concat(device, F.lit("_"), date, F.lit("_"), _time(local_seconds, 3), F.lit(".jpg"))


def folder_name(device: Column, local_from: Column, local_to: Column) -> Column:
    """Landing folder of one pull request."""
    stamp = [F.concat(_month_day(t), F.lit("_"), _time(t, 2)) for t in (local_from, local_to)]
    return F.concat(device, stamp[0], F.lit("_to_"), stamp[1])


def time_of_day(name: Column) -> Column:
    """Seconds since midnight read from a file name; null when the name has no time part."""
    h, m, s = (F.nullif(F.regexp_extract(name, TIME_IN_NAME, k), F.lit("")).try_cast("bigint") for k in (1, 2, 3))
    return h * 3600 + m * 60 + s


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a TIMESTAMP_NTZ column."""
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )
