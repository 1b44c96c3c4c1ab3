"""Numeric expressions behind the detectors and the quality measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType

from recordlens.functions.names import named

INFINITY = float("inf")


def finite(df: DataFrame, column: str) -> Column:
    """``column`` as a double, with NaN and the infinities turned into null.

    Spark orders NaN above every number, so one comparison drops all three. A
    single NaN would otherwise make the mean NaN and flag every other row.
    """
    value = named(column).cast("double")
    if not isinstance(df.schema[column].dataType, FractionalType):
        return value
    return F.when(F.abs(value) < F.lit(INFINITY), value)


def z_score(x: Column, mean: Column, spread: Column) -> Column:
    """Distance from ``mean`` in units of ``spread``; 0 where there is no usable spread.

    The spread is null for a single value, 0 for a constant column, and NaN or
    infinite when the squares overflow. A null ``x`` has a null score.
    """
    usable = (spread > 0) & (spread < F.lit(INFINITY))
    return F.when(usable, F.abs((x - mean) / spread)).otherwise(F.abs(x * 0))


def fence_score(x: Column, q1: Column, q3: Column, multiplier: float) -> Column:
    """How many interquartile ranges ``x`` lies beyond the nearer Tukey fence."""
    width = q3 - q1
    reach = F.lit(float(multiplier)) * width
    beyond = F.greatest(
        F.lit(0.0), ((q1 - reach) - x) / width, (x - (q3 + reach)) / width
    )
    usable = (width > 0) & (width < F.lit(INFINITY)) & x.isNotNull()
    return F.when(usable, beyond).otherwise(F.abs(x * 0))


def rounded(x: Column, digits: int) -> Column:
    """``round(x, digits)`` of a double, without decimals where they make no difference.

    Those that Spark goes by cost more than a pair's comparison. A whole number over a power
    of ten, both exact, is divided to the nearest double, which is the decimal's double, too.
    Near a tie, for large values and for NaN Spark decides.
    """
    scaled = x * F.lit(10.0**digits)
    off = F.abs(scaled - F.floor(scaled) - F.lit(0.5))
    plain = (F.abs(scaled) < F.lit(1e12)) & (off > F.lit(1e-3))
    # With 0.0, since a rounded double has no negative zero.
    return F.when(plain, F.rint(scaled) / F.lit(10.0**digits) + F.lit(0.0)).otherwise(
        F.round(x, digits)
    )


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0.0 where ``whole`` is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(
        part.cast("double") / whole.cast("double")
    )


def harmonic_mean(a: Column, b: Column) -> Column:
    """F1 of a precision and a recall, 0.0 when both are 0."""
    return F.when(a + b == 0, F.lit(0.0)).otherwise(2 * a * b / (a + b))


def pair_count(size: Column) -> Column:
    """Unordered pairs in a group of ``size`` rows, as ``decimal(38,0)``.

    A group of 5e9 rows already has more pairs than a long can hold, and a
    double loses exactness beyond 2**53.
    """
    n = size.cast("bigint")
    half, rest = F.shiftright(n, 1), n - 1 + n % 2
    return (half.cast("decimal(19,0)") * rest.cast("decimal(19,0)")).cast("decimal(38,0)")
