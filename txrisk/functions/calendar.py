"""Date/time expressions (parsing, parts, names, calendar flags)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from txrisk.schema import MONTH_NAMES, PEAK_HOURS

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_timestamp(c: Column, dtype: DataType) -> Column:
    """Strict parse of ``yyyy-MM-dd HH:mm:ss`` strings; timestamps pass.

    ``to_timestamp`` with an explicit pattern raises on a mismatch under
    ANSI mode, like the strict pandas parse it replaces.
    """
    if isinstance(dtype, StringType):
        return F.to_timestamp(c, TIMESTAMP_FORMAT)
    return c


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp.

    Uses ``timestamp_diff`` against an NTZ epoch so the value does not depend
    on the session time zone (works for TIMESTAMP and TIMESTAMP_NTZ).
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz"))


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def is_peak_hour(ts: Column) -> Column:
    return F.hour(ts).isin(*PEAK_HOURS)


def calendar_ints(ts: Column) -> dict[str, Column]:
    """hour, day_of_week (0=Mon), month, is_weekend, is_peak_hour."""
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
        "is_weekend": is_weekend(ts),
        "is_peak_hour": is_peak_hour(ts),
    }


def month_name(ts: Column) -> Column:
    return F.date_format(ts, "MMMM")


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def time_of_day(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def month_num_of_name(name: Column) -> Column:
    """Calendar position (1..12) of an English month name (order key)."""
    expr = None
    for i, m in enumerate(MONTH_NAMES, start=1):
        expr = F.when(name == m, i) if expr is None else expr.when(name == m, i)
    return expr
