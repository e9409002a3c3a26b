"""Incremental table semantics as pure DataFrame functions.

The writing forms live in ``sources.writers``; these say what the table holds
afterwards and need no table format.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.constants import NO_WATERMARK, STALE_AFTER_DAYS
from wardmill.functions.measures import flag


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], since: str | None = None, on: str | None = None
) -> DataFrame:
    """Target rows without a source row of the same key, plus all source rows.

    ``source`` is unique on ``keys``. With ``since`` only target rows dated from
    then on (column ``on``) can be replaced; older ones stay untouched, so the
    anti join does not see them at all.
    """
    source = source.select(*target.columns)
    if since is None:
        return target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(source)
    bound = F.lit(since).cast("date")
    recent = target.filter(F.col(on) >= bound)
    settled = target.filter((F.col(on) < bound) | F.col(on).isNull())
    kept = recent.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return settled.unionByName(kept).unionByName(source)


def newer_than_target(target: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """Source rows past the target's high-water mark; an empty target takes all."""
    mark = target.agg(F.coalesce(F.max(F.col(column).cast("date")), F.lit(NO_WATERMARK).cast("date")).alias("mark"))
    return source.filter(F.col(column).cast("date") > mark.scalar())


def append_since(target: DataFrame, source: DataFrame, column: str) -> DataFrame:
    return target.unionByName(newer_than_target(target, source, column))


def replace_run(target: DataFrame, batch: DataFrame, run_column: str, run: str) -> DataFrame:
    """Delete one run's rows, insert the batch."""
    other = (F.col(run_column) != F.lit(run).cast("date")) | F.col(run_column).isNull()
    return target.filter(other).unionByName(batch.select(*target.columns))


def late_window(target: DataFrame, source: DataFrame, column: str, lookback_days: int) -> DataFrame:
    """Source rows from the look-back before the target's newest run; an empty target takes all."""
    mark = target.agg(
        F.coalesce(F.date_sub(F.max(F.col(column).cast("date")), lookback_days), F.lit(NO_WATERMARK).cast("date"))
        .alias("mark")
    )
    return source.filter(F.col(column).cast("date") >= mark.scalar())


def incremental_upsert(
    target: DataFrame, source: DataFrame, column: str, lookback_days: int, keys: Sequence[str]
) -> DataFrame:
    return merge_upsert(target, late_window(target, source, column, lookback_days), keys)


def has_new_data(
    features: DataFrame, processed: DataFrame, as_of: str, date: str = "report_date", run: str = "run_date"
) -> DataFrame:
    """One row: newest feature date up to the run, newest date of earlier runs, and whether to go on."""
    day = F.lit(as_of).cast("date")
    newest = features.filter(F.col(date) <= day).agg(F.max(date).alias("newest_feature"))
    done = processed.filter(F.col(run) < day).agg(F.max(date).alias("newest_processed"))
    return newest.withColumn("newest_processed", done.scalar()).withColumn(
        "has_new_data",
        F.col("newest_feature").isNotNull()
        & (F.col("newest_processed").isNull() | (F.col("newest_feature") > F.col("newest_processed"))),
    )


def freshness(df: DataFrame, date: str, as_of: str, max_days: int = STALE_AFTER_DAYS) -> DataFrame:
    day = F.lit(as_of).cast("date")
    return df.filter(F.col(date) <= day).agg(
        flag(F.count(F.lit(1)) > 0).alias("has_data"),
        F.coalesce(flag(F.datediff(day, F.max(date)) <= max_days), F.lit(0)).alias("data_not_stale"),
    )
