"""Joins whose left side has a few very frequent keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.001


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of the rows: fewer than 1/share of them can exist."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("total"))
    return counts.filter(F.col("_rows") > total.scalar() * F.lit(share)).select(*keys)


def hot_key_left_join(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], share: float = HOT_SHARE
) -> DataFrame:
    """Left join on a dimension that is unique per key, safe for hot fact keys.

    Rows of hot keys meet the dimension rows of those keys, of which there are
    fewer than ``1/share`` if the dimension is unique; Spark broadcasts them if
    they are as few as that, and splits the hot side otherwise. Rows without a
    complete key can't match and pass by the join. All other rows take an
    ordinary shuffle join, in which no key is large. ``share`` chooses the plan,
    not the result: the three parts are disjoint and complete.

    Use it where the runtime skew handling of a sort-merge join does not apply,
    for example when the join's own partitioning is needed further up.
    """
    absent = reduce(or_, [F.col(k).isNull() for k in keys])
    keyed, keyless = fact.filter(~absent), fact.filter(absent)
    hot = heavy_keys(keyed, keys, share)
    hot_dim = dim.join(F.broadcast(hot), list(keys), "left_semi")
    hot_rows = keyed.join(F.broadcast(hot), list(keys), "left_semi")
    other_rows = keyed.join(F.broadcast(hot), list(keys), "left_anti")
    unmatched = keyless.withColumns({n: F.lit(None).cast(dim.schema[n].dataType) for n in dim.columns if n not in keys})
    return hot_rows.join(hot_dim, list(keys), "left").unionByName(
        other_rows.join(dim, list(keys), "left")
    ).unionByName(unmatched)
