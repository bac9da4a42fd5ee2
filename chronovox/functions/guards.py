"""Arithmetic that is defined where the plain form divides by zero.

Spark's ANSI mode raises on a division by zero, and on the correlation of a
constant.  All ratios go through try_divide, so they are null there; callers
then apply the policy of their operator (mostly null becomes 0).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(col(a), col(b))


def pearson(x: Column | str, y: Column | str) -> Column:
    """Aggregate: correlation, null if either side is constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def zero_if_null(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def finite_or_zero(x: Column | str) -> Column:
    """0 for null, NaN and the infinities."""
    c = col(x)
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c)


def rms(x: Column | str) -> Column:
    """Aggregate: root of the mean square."""
    return F.sqrt(F.avg(col(x) * col(x)))


def norm(x: Column | str) -> Column:
    """Aggregate: root of the sum of squares."""
    return F.sqrt(F.sum(col(x) * col(x)))


def trimean(x: Column | str) -> Column:
    """Aggregate: mean of the quantiles .2, .5 and .8, each interpolated."""
    q = F.percentile(col(x), F.array(F.lit(0.2), F.lit(0.5), F.lit(0.8)))
    return (q[0] + q[1] + q[2]) / 3
