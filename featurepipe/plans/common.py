"""Shared helpers for registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6  # doubles are rounded to this many places on both sides of an oracle check
# Relative nudge applied before rounding. Means of 2-decimal amounts over 2^k
# rows end exactly on a rounding tie, where summation order decides the side;
# the nudge (far above summation error, far below 10^-DIGITS) moves exact ties
# off the boundary the same way in Spark and in the SQL oracle.
NUDGE = 1.000000000001


def rounded(x: Column) -> Column:
    """About 8 significant digits: decimals by magnitude (the SQL oracle uses the same CASE).

    Two engines agree to an ulp or so; a fixed number of decimals on large
    values (amounts in the 10^4-10^5 range) would keep 11+ digits and let a
    1-ulp difference straddle a rounding boundary. ``+ 0.0`` turns -0.0 into 0.0.
    """
    v = x * F.lit(NUDGE)
    a = F.abs(x)
    return (
        F.when(a < 100, F.round(v, 6))
        .when(a < 10_000, F.round(v, 4))
        .when(a < 1_000_000, F.round(v, 2))
        .otherwise(F.round(v, 0))
    ) + F.lit(0.0)


def flat(df: DataFrame, digits: int = DIGITS, as_double: tuple[str, ...] = ()) -> DataFrame:
    """Normalise result types for the oracle compare: doubles rounded, ints as bigint.

    ``as_double`` names integer columns that can be null (e.g. features of an
    unmatched as-of row); they are compared as doubles, as pandas would hold them.
    """
    cols: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in as_double or isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = rounded(c.cast("double"))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
