"""Calendar helpers on DATE columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sunday_week(d: Column) -> Column:
    """First day of the week that starts on Sunday."""
    return F.date_sub(d, F.dayofweek(d) - 1)


def weekday_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def season(d: Column) -> Column:
    m = F.month(d)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )


def is_flu_season(d: Column) -> Column:
    """October to May. The models that read this flag leave it undefined; this is our definition."""
    m = F.month(d)
    return (m >= 10) | (m <= 5)


def disease_season(d: Column) -> Column:
    return F.when(is_flu_season(d), "Flu").otherwise("Off")


def risk_level(d: Column) -> Column:
    m = F.month(d)
    return (
        F.when(m.isin(12, 1, 2), "High")
        .when(m.isin(10, 11, 3, 4, 5), "Medium")
        .otherwise("Low")
    )


def week_of_month(d: Column) -> Column:
    return F.ceil(F.dayofmonth(d) / 7).cast("int")


def quarter_tag(d: Column) -> Column:
    return F.concat(F.lit("q"), F.quarter(d).cast("string"), F.lit("_"), F.year(d).cast("string"))


def within_days(d: Column, as_of: str, days: int) -> Column:
    """Trailing window of ``days`` ending at ``as_of``; literals only, so it reaches the scan."""
    end = F.lit(as_of).cast("date")
    return d.between(F.date_sub(end, days), end)
