"""Event-time helpers. Everything is epoch arithmetic, so no session zone gets in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Width of a time-of-day slot.
SLOT_MINUTES = 120


def hours(n: int) -> str:
    return f"{n} hours"


def days(n: int) -> str:
    return f"{n} days"


def hour_of_day(ts: Column) -> Column:
    """UTC hour of a timestamp."""
    return F.pmod(F.floor(F.unix_seconds(ts) / F.lit(3600)), F.lit(24)).cast("int")


def last_instant(window: Column) -> Column:
    """The last microsecond inside the window: the time a window result carries onward."""
    return F.timestamp_micros(F.unix_micros(window["end"]) - F.lit(1))
