"""Expressions on the zone-less sample time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barograph import fixed

TIME = "record_time"


def sample_date() -> Column:
    return F.to_date(TIME)


def sample_hour() -> Column:
    return F.hour(TIME)


def shift_to_second(time: Column, rounding) -> Column:
    """Move a TIMESTAMP_NTZ to the whole second chosen by ``rounding``.

    ``date_trunc`` would pass through the session zone, which has hours that do not exist.
    """
    seconds = F.extract(F.lit("SECOND"), time)
    zero = F.lit(0)
    return time + F.make_dt_interval(zero, zero, zero, (rounding(seconds) - seconds).cast("decimal(18,6)"))


def nearest_second(time: Column) -> Column:
    return shift_to_second(time, F.round)


def floor_second(time: Column) -> Column:
    return shift_to_second(time, F.floor)


def day_period(hours: tuple[int, int] = fixed.DAY_HOURS) -> Column:
    return F.when(sample_hour().between(*hours), fixed.DAYTIME).otherwise(fixed.NIGHT)


def day_type() -> Column:
    """Weekend is Sunday (1) and Saturday (7)."""
    return F.when(F.dayofweek(TIME).isin(1, 7), fixed.WEEKEND).otherwise(fixed.WEEKDAY)
