"""One row per key, chosen by a stated order.

``row_number() = 1`` is planned with a group limit before the shuffle: every
map task sends at most one row per key, so a key that holds a large part of the
table costs its reducer one row per map task, never the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType

from wardmill.functions.dates import within_days

_RANK = "_row_rank"


def content_order(df: DataFrame, names: Sequence[str] | None = None) -> list[Column]:
    """Tie-break on the row's own content: the result does not depend on partitioning."""
    wanted = set(names) if names is not None else set(df.columns)
    return [
        F.col(f.name).desc_nulls_last()
        for f in df.schema.fields
        if f.name in wanted and isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, BinaryType)
    ]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """First row per key in ``order``, then in content order."""
    ranked = [n for n in df.columns if n not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *content_order(df, ranked))
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)


def keep_latest(df: DataFrame, keys: Sequence[str], *newest: str) -> DataFrame:
    return keep_first(df, keys, [F.col(n).desc_nulls_last() for n in newest])


def latest_snapshot(
    df: DataFrame, entity: str, date: str, as_of: str, lookback_days: int
) -> DataFrame:
    """Newest row per entity inside the look-back that ends at ``as_of``."""
    return keep_latest(df.filter(within_days(F.col(date), as_of, lookback_days)), [entity], date)


def latest_only(df: DataFrame, name: str) -> DataFrame:
    """Rows of the newest value of one column; the maximum is a scalar subquery."""
    newest = df.agg(F.max(name).alias("newest"))
    return df.filter(F.col(name) == newest.scalar())


def pick_champion(metrics: DataFrame, preferred: str, model: str = "model_name", mae: str = "mae") -> DataFrame:
    """Smallest error is production, the rest candidates; ties go to the preferred model.

    The winner is found as a one-row aggregate, so no task sees more than
    partial minima however many models are registered.
    """
    order = F.struct(F.col(mae), (F.col(model) != preferred).cast("int"), F.col(model))
    winner = metrics.agg(F.min_by(F.col(model), order).alias("winner"))
    return metrics.withColumn(
        "status", F.when(F.col(model) == winner.scalar(), "production").otherwise("candidate")
    )
