"""Weekly panel operators: one row per entity and week.

The panel key (entity, week) is unique (``fact`` upserts on it), so one
entity's window partition holds at most one row per week of the date range. All
windows below share one definition and therefore one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wardmill.constants import PERSISTENT_OVERLOAD, PERSISTENT_WEEKS
from wardmill.functions.measures import safe_div


def panel_window(entity: str | Sequence[str], date: str) -> WindowSpec:
    return Window.partitionBy(*([entity] if isinstance(entity, str) else entity)).orderBy(date)


def add_lags(df: DataFrame, spec: Mapping[str, Sequence[tuple[int, str]]], w: WindowSpec) -> DataFrame:
    """``{column: [(rows back, alias), ...]}``; rows, not calendar weeks."""
    return df.withColumns({a: F.lag(c, n).over(w) for c, items in spec.items() for n, a in items})


def add_rolling(df: DataFrame, spec: Mapping[str, Sequence[tuple[int, str]]], w: WindowSpec) -> DataFrame:
    """``{column: [(rows, alias), ...]}``: means over the last rows, the current one included."""
    return df.withColumns({
        a: F.avg(c).over(w.rowsBetween(1 - n, 0)) for c, items in spec.items() for n, a in items
    })


def add_change(df: DataFrame, column: str, alias: str, w: WindowSpec) -> DataFrame:
    """Relative change to the previous row; NULL where that is absent or zero."""
    previous = F.lag(column, 1).over(w)
    return df.withColumn(alias, safe_div(F.col(column) - previous, previous))


def add_next(df: DataFrame, column: str, alias: str, w: WindowSpec) -> DataFrame:
    return df.withColumn(alias, F.lead(column, 1).over(w))


def complete_rows(df: DataFrame, required: Sequence[str]) -> DataFrame:
    condition = F.lit(True)
    for n in required:
        condition = condition & F.col(n).isNotNull()
    return df.filter(condition)


def panel_filter(df: DataFrame, capacity: str, date: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Bare columns against literals, so all conditions reach the scan; a bound that is None is open."""
    kept = df.filter(F.col(capacity) > 0)
    if start is not None:
        kept = kept.filter(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        kept = kept.filter(F.col(date) <= F.lit(end).cast("date"))
    return kept


def densify_weeks(df: DataFrame, entity: str, date: str) -> DataFrame:
    """One row per entity and calendar week between its first and last one; added rows have NULL measures.

    Turns row lags into calendar lags. Each entity expands its own short range
    of weeks, so no row is paired with a foreign one.
    """
    spans = df.groupBy(entity).agg(F.min(date).alias("_from"), F.max(date).alias("_to"))
    weeks = spans.select(
        entity, F.explode(F.sequence("_from", "_to", F.expr("interval 7 days"))).alias(date)
    )
    return weeks.join(df, [entity, date], "left")


def persistent_overload(
    df: DataFrame,
    entity: str,
    date: str,
    rate: str,
    threshold: float = PERSISTENT_OVERLOAD,
    min_weeks: int = PERSISTENT_WEEKS,
) -> DataFrame:
    """Runs of consecutive snapshots above the threshold that last long enough.

    Consecutive means neighbouring snapshots of the entity; a row at or below
    the threshold (or without a rate) ends the run.
    """
    w = panel_window(entity, date)
    over = F.coalesce(F.col(rate) > threshold, F.lit(False))
    position = F.row_number().over(w)
    seen = F.sum(over.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        df.select(entity, date, rate, over.alias("_over"), (position - seen).alias("_run"))
        .filter("_over")
        .groupBy(entity, "_run")
        .agg(
            F.min(date).alias("run_start"),
            F.max(date).alias("run_end"),
            F.count(F.lit(1)).alias("n_weeks"),
            F.max(rate).alias("peak_rate"),
        )
        .filter(F.col("n_weeks") >= min_weeks)
        .drop("_run")
    )


def temporal_split(df: DataFrame, date: str, train_end: str, validation_end: str) -> DataFrame:
    """Adds ``split``: train up to the first bound, val up to the second, test after it."""
    d = F.col(date)
    return df.withColumn(
        "split",
        F.when(d <= F.lit(train_end).cast("date"), "train")
        .when(d <= F.lit(validation_end).cast("date"), "val")
        .when(d.isNotNull(), "test"),
    )
