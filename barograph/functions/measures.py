"""Aggregate expressions on DECIMAL(10,2) channels, exact to the last digit.

Spark's own ``avg`` of such a column adds up doubles, whose last digits depend on the
order of the rows once a sum passes 2**53. Adding hundredths as BIGINT is as fast, keeps
the partial sums in the hash aggregate's fixed-width buffer, and is exact: a group holds
4.6e11 samples at 200,000 lux before the sum leaves BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barograph.schema import CHANNEL


def hundredths(name: str) -> Column:
    """The channel in whole hundredths; a DECIMAL(10,2) survives the trip through double."""
    return F.rint(F.col(name).cast("double") * 100).cast("bigint")


def mean(name: str, places: int = 6) -> Column:
    """Mean rounded half away from zero, once, to ``places`` decimals; NULL without values."""
    return mean_of(F.sum(hundredths(name)), F.count(name), places)


def mean_of(total: Column, count: Column, places: int = 6) -> Column:
    """The same from a sum of hundredths and a number of values."""
    total, count = total.cast("decimal(19,0)"), count.cast("decimal(19,0)")
    return (F.round(F.try_divide(total, count), places - 2) * F.lit("0.01").cast("decimal(2,2)")).cast(
        f"decimal({places + 8},{places})"
    )


def highest(name: str) -> Column:
    return F.max(name).cast(CHANNEL)


def lowest(name: str) -> Column:
    return F.min(name).cast(CHANNEL)


def spread(name: str) -> Column:
    return (F.max(name) - F.min(name)).cast(CHANNEL)


def rows() -> Column:
    return F.count(F.lit(1))


def percentage(part: Column, whole: Column, places: int = 2) -> Column:
    """``part`` of ``whole`` in percent, rounded half up; NULL when ``whole`` is zero."""
    ratio = F.try_divide(part.cast("decimal(19,0)") * 100, whole.cast("decimal(19,0)"))
    return F.round(ratio, places).cast(f"decimal({places + 5},{places})")
