"""Date parameters (``yyyy-MM-dd`` strings) and date columns."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# A raw event time, yyyyMMddHHmmssSSS (fixed value).
TM_PATTERN = "^[0-9]{17}$"
# The zone event times are written in (fixed value).
EVENT_ZONE = "UTC+8"


def shift(day: str, days: int) -> str:
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def table_suffix(day: str) -> str:
    """``2024-01-31`` -> ``2024_01_31``."""
    return date.fromisoformat(day).isoformat().replace("-", "_")


def compact(day: str) -> str:
    """``2024-01-31`` -> ``20240131``."""
    return date.fromisoformat(day).strftime("%Y%m%d")


def month_name(name: str, day: str) -> str:
    """Put the month of ``day`` where ``name`` says ``yyyymm``."""
    return name.replace("yyyymm", date.fromisoformat(day).strftime("%Y%m"))


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyyMM")


def underscored(day: Column) -> Column:
    return F.replace(day.cast("string"), F.lit("-"), F.lit("_"))


def on_grid(day: Column, anchor: str, step: int = 14) -> Column:
    """True on every ``step``-th day counted from ``anchor``, in both directions."""
    return F.datediff(day, F.lit(anchor).cast("date")) % step == 0


def parse_tm(tm: Column, zoned: bool = False) -> Column:
    """A 17-digit time as a timestamp, NULL when malformed.

    ``zoned`` reads it in the session time zone; otherwise it stays a wall time.
    """
    day = F.concat_ws("-", F.substring(tm, 1, 4), F.substring(tm, 5, 2), F.substring(tm, 7, 2))
    clock = F.concat_ws(":", F.substring(tm, 9, 2), F.substring(tm, 11, 2), F.substring(tm, 13, 2))
    text = F.concat(day, F.lit(" "), clock, F.lit("."), F.substring(tm, 15, 3))
    return F.when(tm.rlike(TM_PATTERN), text.try_cast("timestamp" if zoned else "timestamp_ntz"))


def event_instant(tm: Column, zone: str = EVENT_ZONE) -> Column:
    """The moment of an event time written in ``zone``, as a wall time in UTC; the session's zone plays no part."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), parse_tm(tm))
