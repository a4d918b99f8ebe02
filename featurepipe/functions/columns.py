"""Scalar column expressions shared by the operators.

All of these compile to Catalyst expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from featurepipe.fixed import LATE_NIGHT_AFTER_HOUR, LATE_NIGHT_BEFORE_HOUR, RATIO_DENOMINATOR_IF_MISSING



def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a zone-less time (independent of the session zone)."""
    return F.timestamp_diff("MICROSECOND", _epoch(), _c(ts).cast("timestamp_ntz"))


def ntz_from_micros(us) -> Column:
    """Inverse of :func:`epoch_micros`: a TIMESTAMP_NTZ from epoch microseconds."""
    return F.timestamp_add("MICROSECOND", _c(us), _epoch())


def to_instant(ts) -> Column:
    """Read a zone-less time as a UTC instant (TIMESTAMP), whatever the session zone.

    Streaming watermarks need TIMESTAMP, while the tables hold TIMESTAMP_NTZ.
    """
    return F.timestamp_micros(epoch_micros(ts))


def is_late_night(ts) -> Column:
    """1 when the hour is before 6 or after 22 (so 22:xx is day and 23:xx night)."""
    h = F.hour(_c(ts))
    return F.when((h < LATE_NIGHT_BEFORE_HOUR) | (h > LATE_NIGHT_AFTER_HOUR), F.lit(1)).otherwise(F.lit(0))


def is_weekend(ts) -> Column:
    """1 on Saturday and Sunday (fixed.WEEKEND_DAYS). Spark numbers days 1 = Sunday .. 7 = Saturday."""
    return F.when(F.dayofweek(_c(ts)).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def safe_ratio(num, den, default_den: float = RATIO_DENOMINATOR_IF_MISSING) -> Column:
    """num / coalesce(den, default); null (not an error) when the denominator is 0."""
    return F.try_divide(_c(num), F.coalesce(_c(den), F.lit(default_den)))


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def version_number(v) -> Column:
    """Number n of a version string 'V<n>'; null for anything else ('Vx', 'v2', '')."""
    digits = F.regexp_extract(_c(v), r"^V(\d+)$", 1)
    return F.when(digits != "", digits.cast("bigint"))
