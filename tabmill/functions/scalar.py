"""Column expressions with NumPy's edge values where Spark's differ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
INF = float("inf")


def natural_log(x: Column) -> Column:
    """ln with ln(0) = -inf and ln(negative) = NaN; Spark's own ln gives null for both."""
    return (
        F.when(x > 0, F.ln(x))
        .when(x == 0, F.lit(-INF))
        .when(x < 0, F.lit(NAN))
    )


def sign(x: Column) -> Column:
    """L2 normalisation of a single value: x / |x|, and 0 stays 0."""
    return F.signum(x)


def skip_nan(x: Column) -> Column:
    """NaN becomes null so that aggregates skip it."""
    return F.when(~F.isnan(x), x)


def missing(x: Column, data_type: str) -> Column:
    """Null, or NaN for floating columns."""
    return x.isNull() | F.isnan(x) if data_type in ("double", "float") else x.isNull()


def quoted(name: str) -> Column:
    """Column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def round_half_even(x: Column, digits: int) -> Column:
    """Decimal rounding of the exact binary value, halves to even.

    Spark's own rounding works on the shortest decimal text of a double, which takes many values
    for halves that lie next to one. The scaled value is split into a product and its exact error.
    """
    scale = F.lit(float(10**digits))
    x = x.cast("double")
    product = x * scale
    c = x * F.lit(134217729.0)
    high = c - (c - x)
    error = (high * scale - product) + (x - high) * scale
    below = F.floor(product).cast("double")
    fraction = product - below
    odd = F.pmod(below, F.lit(2.0)) == 1
    up = (fraction > 0.5) | ((fraction == 0.5) & ((error > 0) | ((error == 0) & odd)))
    rounded = (below + F.when(up, 1.0).otherwise(0.0)) / scale
    # beyond this no decimals are left to round
    return F.when(F.abs(product) < F.lit(2.0**52), rounded).otherwise(x)
