"""Which rows of a panel a change of some rows can reach, and which partitions must be read to recompute them.

A window of ``back`` rows before and ``ahead`` rows after carries a changed row to the ``back`` rows after it and the
``ahead`` rows before it. Rows, not weeks, are counted: an entity that missed weeks is reached further away. Partitions are
therefore read to a reach that is widened, for the weeks concerned, until every changed row has its neighbours.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ISLAND = "_island"


def islands(partitions: Sequence[str], reach: Mapping[str, int]) -> list[tuple[str, str]]:
    """First and last date of each stretch to be read: so many partitions on either side of each changed one.

    A changed date without a partition lies between two, or past an end of the table; its stretch contains it all the same.
    """
    found: list[tuple[int, int, str, str]] = []
    for value, n in sorted(reach.items()):
        at = bisect_left(partitions, value)
        there = at < len(partitions) and partitions[at] == value
        first, last = max(0, at - n), min(len(partitions) - 1, at + n - (0 if there else 1))
        own = (first, last, min(value, partitions[first]), max(value, partitions[last]))
        if found and first <= found[-1][1] + 1:
            a, b, low, high = found.pop()
            own = (a, max(b, last), min(low, own[2]), max(high, own[3]))
        found.append(own)
    return [(low, high) for _, _, low, high in found]


def island_of(date: Column, stretches: Sequence[tuple[str, str]]) -> Column:
    """Number of the stretch that a date belongs to; a date between two belongs to none."""
    out = F.lit(None).cast("int")
    for i, (first, last) in enumerate(stretches):
        out = F.when(date.between(F.lit(first).cast("date"), F.lit(last).cast("date")), F.lit(i)).otherwise(out)
    return out


def in_stretches(date: Column, stretches: Sequence[tuple[str, str]]) -> Column:
    """Plain comparisons of the bare column, which prune partitions."""
    condition = F.lit(False)
    for first, last in stretches:
        condition = condition | ((date >= F.lit(first).cast("date")) & (date <= F.lit(last).cast("date")))
    return condition


def with_reach(panel: DataFrame, changed: DataFrame, entity: str, date: str, back: int, ahead: int) -> DataFrame:
    """Rows of the panel and of ``changed`` (``_real`` 1 and 0), with ``_affected``, ``_before`` and ``_after``.

    Both have ``_island``; stretches do not see each other. A changed key stands for a row that is new, has other values or is
    gone. Its place among the real rows decides: reached are the real rows whose number of predecessors is at most ``back`` more
    and ``ahead`` less than its own. For a changed key, ``_before`` and ``_after`` count the real rows on its sides, itself included after.
    """
    both = panel.withColumns({"_real": F.lit(1), "_changed": F.lit(0)}).unionByName(
        changed.select(entity, date, ISLAND).withColumns({"_real": F.lit(0), "_changed": F.lit(1)}), allowMissingColumns=True
    )
    own = Window.partitionBy(entity, ISLAND)
    before = F.coalesce(F.sum("_real").over(own.orderBy(date, "_real").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = both.withColumn("_before", before.cast("int"))
    total = F.sum("_real").over(own)
    reached = F.max("_changed").over(own.orderBy("_before").rangeBetween(-back, ahead))
    return placed.withColumns({"_after": (total - F.col("_before")).cast("int"), "_affected": (F.col("_real") == 1) & (reached == 1)})


def short_of_rows(reached: DataFrame, spans: DataFrame, stretches: Sequence[tuple[str, str]], partitions: Sequence[str],
                  entity: str, date: str, back: int, ahead: int) -> DataFrame:
    """Dates of changed keys whose neighbours are not all read, though the entity has earlier or later rows.

    ``spans``: ``first`` and ``last`` date of each entity; an entity that is not in it has no rows outside.
    """
    lows = F.array(*[F.lit(a if a > partitions[0] else None).cast("date") for a, _ in stretches])
    highs = F.array(*[F.lit(b if b < partitions[-1] else None).cast("date") for _, b in stretches])
    at = F.col(ISLAND)
    keys = reached.filter("_real = 0").join(spans, [entity], "left")
    missing = ((F.col("_before") < back + ahead) & (F.col("first") < F.get(lows, at))) | (
        (F.col("_after") < back + ahead + 1) & (F.col("last") > F.get(highs, at)))
    return keys.filter(missing).select(date).distinct()
