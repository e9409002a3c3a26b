"""Ranks, running totals and exact medians that never sort one group in one task.

A plain window sorts a whole group in one task; with a third of the table in
one group that task decides the runtime. Here the distinct order values are cut
into ranges at values drawn by hash, of any type that Spark can order: texts
with a common beginning spread as well as numbers. A window over (group, range)
is then small, and what precedes a range is a sum over at most ``buckets``
partial sums per group. Ranges only spread the work: the results are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Number of ranges; callers with more distinct values than a few million per range pass a larger one.
BUCKETS = 4096
_BUCKET = "_value_bucket"
_SPLITS = "_value_splits"


def with_value_bucket(distinct: DataFrame, value: str, buckets: int = BUCKETS) -> DataFrame:
    """Tag distinct values with their range: larger values never get a lower one.

    The splitters are the ``buckets - 1`` values of smallest hash, found by a
    top-k per task, so they are the same however the rows lie.
    """
    c = F.col(value)
    sample = distinct.select(c).orderBy(F.xxhash64(c), c).limit(max(1, buckets - 1))
    splits = sample.agg(F.array_sort(F.collect_set(c)).alias("splits"))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, buckets.bit_length())))])
    place = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(c >= F.try_element_at(F.col(_SPLITS), at + step), at + step).otherwise(at),
    )
    return distinct.withColumn(_SPLITS, splits.scalar()).withColumn(_BUCKET, place).drop(_SPLITS)


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    measures: Mapping[str, Column],
    descending: bool = False,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per distinct ``order`` value: each measure's sum and its running total up to and with that value.

    Output: ``by``, ``order``, ``<m>``, ``cum_<m>`` and the group's ``all_<m>``.
    Rows with a NULL order value are left out. Duplicates are combined map-side
    first, so hot values shrink to one row per task before anything is shuffled.
    """
    distinct = (
        df.filter(F.col(order).isNotNull())
        .groupBy(*by, order)
        .agg(*[F.sum(c).alias(m) for m, c in measures.items()])
    )
    tagged = with_value_bucket(distinct, order, buckets)
    part = tagged.groupBy(*by, _BUCKET).agg(*[F.sum(m).alias(f"_part_{m}") for m in measures])
    direction = F.col(_BUCKET).desc() if descending else F.col(_BUCKET).asc()
    # At most `buckets` rows per group: bounded by construction, whatever the data.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    whole = group.orderBy(direction).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = part.select(
        *[F.col(b).alias(f"_by_{b}") for b in by],
        F.col(_BUCKET).alias("_by_bucket"),
        *[F.coalesce(F.sum(f"_part_{m}").over(earlier), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(f"_part_{m}").over(whole).alias(f"_all_{m}") for m in measures],
    )
    # Null-safe although never NULL: no filter on the bucket expression is inferred and pushed around.
    match = tagged[_BUCKET].eqNullSafe(offsets["_by_bucket"])
    for b in by:
        match = match & tagged[b].eqNullSafe(offsets[f"_by_{b}"])
    inner_order = F.col(order).desc() if descending else F.col(order).asc()
    inside = (
        Window.partitionBy(*by, _BUCKET).orderBy(inner_order).rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = tagged.join(offsets, match, "inner")
    return joined.select(
        *by,
        order,
        *measures,
        *[(F.col(f"_before_{m}") + F.sum(m).over(inside)).alias(f"cum_{m}") for m in measures],
        *[F.col(f"_all_{m}").alias(f"all_{m}") for m in measures],
    )


def rank_within(
    df: DataFrame, scope: Sequence[str], measure: str, alias: str = "rank", buckets: int = BUCKETS
) -> DataFrame:
    """``rank() over (partition by scope order by measure desc)`` for groups of any size.

    The measure keeps its type; NULL measures rank last, as in a descending window.
    """
    value = F.struct(F.col(measure).isNotNull().alias("present"), F.col(measure).alias("value"))
    keyed = df.withColumn("_rank_value", value)
    ranks = running_totals(
        keyed, scope, "_rank_value", {"n": F.lit(1)}, descending=True, buckets=buckets
    ).select(
        *[F.col(s).alias(f"_rank_{s}") for s in scope],
        F.col("_rank_value").alias("_rank_match"),
        (F.col("cum_n") - F.col("n") + 1).cast("bigint").alias(alias),
    )
    match = keyed["_rank_value"].eqNullSafe(ranks["_rank_match"])
    for s in scope:
        match = match & keyed[s].eqNullSafe(ranks[f"_rank_{s}"])
    return keyed.join(ranks, match, "inner").drop("_rank_value", "_rank_match", *[f"_rank_{s}" for s in scope])


def dense_codes(df: DataFrame, by: Sequence[str], value: str, alias: str = "code", buckets: int = BUCKETS) -> DataFrame:
    """0-based position of every distinct text within its group, in binary order."""
    distinct = df.filter(F.col(value).isNotNull()).select(*by, value).distinct()
    return running_totals(distinct, by, value, {"n": F.lit(1)}, buckets=buckets).select(
        *by, value, (F.col("cum_n") - 1).cast("int").alias(alias)
    )


def all_groups(df: DataFrame, by: Sequence[str], found: DataFrame) -> DataFrame:
    """``found`` with a row of NULLs for every group of ``df`` that it lacks."""
    if not by:
        return found
    groups = df.select(*[F.col(b).alias(f"_group_{b}") for b in by]).distinct()
    match = reduce(and_, [F.col(f"_group_{b}").eqNullSafe(found[b]) for b in by])
    rest = [n for n in found.columns if n not in by]
    return groups.join(found, match, "left").select(*[F.col(f"_group_{b}").alias(b) for b in by], *rest)


def exact_medians(df: DataFrame, by: Sequence[str], value: str, buckets: int = BUCKETS) -> DataFrame:
    """Median with the mean of the two middle values for an even count.

    ``F.median`` keeps every distinct value of a group in one task's memory;
    this picks the middle positions out of distributed running counts. A group
    without values has a NULL median.
    """
    placed = running_totals(df, by, value, {"n": F.lit(1)}, buckets=buckets)
    first = F.col("cum_n") - F.col("n") + 1
    low = F.floor((F.col("all_n") + 1) / 2)
    high = F.floor((F.col("all_n") + 2) / 2)
    medians = (
        placed.groupBy(*by)
        .agg(
            F.max(F.when(low.between(first, F.col("cum_n")), F.col(value))).alias("_low"),
            F.max(F.when(high.between(first, F.col("cum_n")), F.col(value))).alias("_high"),
        )
        .select(*by, ((F.col("_low") + F.col("_high")) / 2).alias("median"))
    )
    return all_groups(df, by, medians)
