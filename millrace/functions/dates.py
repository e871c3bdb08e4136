"""Date and timestamp columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Single letters also read numbers without leading zeros.
REVIEW_TS_PATTERN = "yyyy-M-d H:m:s"


def whole_years(as_of: Column, birthday: Column) -> Column:
    """Completed years between two dates, truncated toward zero.

    A birthday on 29 February completes its year on 1 March of a common year.
    """
    forward = _years_forward(as_of, birthday)
    return F.when(birthday > as_of, -_years_forward(birthday, as_of)).otherwise(forward)


def _years_forward(late: Column, early: Column) -> Column:
    month_day_late = F.month(late) * 100 + F.dayofmonth(late)
    month_day_early = F.month(early) * 100 + F.dayofmonth(early)
    return F.year(late) - F.year(early) - (month_day_late < month_day_early).cast("int")


def month_end(ts: Column) -> Column:
    return F.last_day(F.to_date(ts))


def coerce_ts(text: Column, pattern: str = REVIEW_TS_PATTERN) -> Column:
    """Text to timestamp; text that does not fit the pattern becomes NULL."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")


def day_start(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end with fractions, NULL if either is missing."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")
