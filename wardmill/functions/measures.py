"""Derived measures, all NULL-safe and free of division errors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardmill.constants import (
    ALERT_THRESHOLD,
    CRITICAL_OCCUPANCY,
    FORECAST_DAYS,
    HIGH_STRAIN_OCCUPANCY,
    INTERVAL_HALF_WIDTH,
    OVERLOAD_OCCUPANCY,
    SQ_MI_TO_KM2,
    WARNING_OCCUPANCY,
)


def safe_div(num: Column, den: Column) -> Column:
    """NULL where the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio(num: Column, den: Column, digits: int, scale: float = 1.0) -> Column:
    """Rounded ratio for a positive denominator, NULL otherwise."""
    value = num.cast("double") / den.cast("double")
    if scale != 1.0:
        value = value * F.lit(float(scale))
    return F.when(den > 0, F.round(value, digits))


def pct_of(num: Column, den: Column, digits: int = 4) -> Column:
    return ratio(num, den, digits, 100.0)


def per_100k(num: Column, population: Column, digits: int = 4) -> Column:
    return ratio(num, population, digits, 100000.0)


def sum_columns(cols: Sequence[Column]) -> Column:
    """Sum that is NULL as soon as one part is NULL."""
    return reduce(add, cols)


def occupancy_pct(used: Column, total: Column) -> Column:
    return pct_of(used, total, 2)


def occupancy_rate(used: Column, total: Column) -> Column:
    return safe_div(used, total)


def overload_flag(rate: Column, threshold: float = OVERLOAD_OCCUPANCY) -> Column:
    return rate > threshold


def available(capacity: Column, used: Column) -> Column:
    return capacity - used


def flag(condition: Column) -> Column:
    """Boolean to 0/1; NULL stays NULL."""
    return condition.cast("int")


def high_strain(rate: Column, threshold: float = HIGH_STRAIN_OCCUPANCY) -> Column:
    return flag(rate > threshold)


def status_label(rate: Column) -> Column:
    return (
        F.when(rate >= CRITICAL_OCCUPANCY, "CRITICAL")
        .when(rate >= WARNING_OCCUPANCY, "WARNING")
        .otherwise("NORMAL")
    )


def as_pct(rate: Column, digits: int = 1) -> Column:
    return F.round(rate * 100, digits)


def clip(c: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; NULL stays NULL (greatest/least alone would hide it)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def interval(prediction: Column, half_width: float = INTERVAL_HALF_WIDTH) -> tuple[Column, Column]:
    known = prediction.isNotNull()
    lower = F.when(known, F.greatest(F.lit(0.0), prediction - half_width))
    upper = F.when(known, F.least(F.lit(1.0), prediction + half_width))
    return lower, upper


def alert_flag(prediction: Column, threshold: float = ALERT_THRESHOLD, inclusive: bool = True) -> Column:
    return prediction >= threshold if inclusive else prediction > threshold


def forecast_date(report_date: Column, days: int = FORECAST_DAYS) -> Column:
    return F.date_add(report_date, days)


def abs_error(actual: Column, prediction: Column, digits: int = 4) -> Column:
    return F.round(F.abs(actual - prediction), digits)


def area_km2(area_sqmi: Column) -> Column:
    return area_sqmi * F.lit(SQ_MI_TO_KM2)


def metro_flag(code: Column) -> Column:
    return F.when(code.between(1, 3), "Metro").when(code.between(4, 9), "Non-Metro")
