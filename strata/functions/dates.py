"""Date and time expressions used by the calendar, the fact transform and the SCD2 code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source warehouse: validity bounds of the unknown member and the
# open end of an active SCD2 version.
LOW_TS = "1900-01-01 00:00:00"
HIGH_TS = "9999-12-31 23:59:59"
LOW_DATE = "1900-01-01"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def high_ts() -> Column:
    return F.lit(HIGH_TS).cast("timestamp_ntz")


def low_ts() -> Column:
    return F.lit(LOW_TS).cast("timestamp_ntz")


def minus_minute(ts) -> Column:
    """``ts - INTERVAL '1 MINUTE'``."""
    return _c(ts) - F.expr("INTERVAL 1 MINUTE")


def iso_dow(d) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7."""
    return (F.weekday(_c(d)) + 1).cast("smallint")


def padded_upper_name(d, pattern: str, width: int = 9) -> Column:
    """Upper-case day/month name blank-padded to ``width`` (``TO_CHAR(d, 'DAY')``), quirk Q19."""
    return F.rpad(F.upper(F.date_format(_c(d), pattern)), width, " ")


def time_id(ts) -> Column:
    """Minute of day ``hour * 60 + minute`` as smallint."""
    return (F.hour(_c(ts)) * 60 + F.minute(_c(ts))).cast("smallint")


def month_id(d) -> Column:
    """``yyyyMM`` integer of a date, the fact's partition column."""
    return (F.year(_c(d)) * 100 + F.month(_c(d))).cast("int")
