"""Group aggregates; all of them combine map-side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.constants import MAX_PERCENTAGE, MAX_UNMAPPED_RATE
from wardmill.functions.dates import quarter_tag
from wardmill.functions.measures import safe_div


def activity_by_season(df: DataFrame, keys: Sequence[str], level: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(level).alias("avg_level"), F.max(level).alias("peak_level"))


def plurality(df: DataFrame, entity: str, choice: Sequence[str], weight: str) -> DataFrame:
    """Per entity the choice with the largest summed weight; ties go to the smallest choice.

    Two map-side combined aggregates: the sums, then the minimum of
    (-sum, choice). Rows with a NULL entity or choice do not vote.
    """
    summed = (
        df.dropna(subset=[entity, *choice])
        .groupBy(entity, *choice)
        .agg(F.sum(weight).alias("total_weight"))
    )
    order = F.struct(-F.coalesce(F.col("total_weight").cast("double"), F.lit(0.0)), *[F.col(c) for c in choice])
    best = summed.groupBy(entity).agg(
        F.min_by(F.struct(*choice, "total_weight"), order).alias("best")
    )
    return best.select(entity, "best.*")


def coverage(pieces: DataFrame, mapped: DataFrame, key: str, max_unmapped: float = MAX_UNMAPPED_RATE) -> DataFrame:
    """One row: keys in all pieces, keys mapped, unmapped rate and whether it is tolerable."""
    total = pieces.agg(F.countDistinct(key).alias("n")).scalar()
    found = mapped.agg(F.countDistinct(key).alias("n")).scalar()
    one = pieces.sparkSession.range(1)
    counted = one.select(total.alias("total_keys"), found.alias("mapped_keys"))
    rate = safe_div(F.col("total_keys") - F.col("mapped_keys"), F.col("total_keys"))
    return counted.withColumn("unmapped_rate", rate).withColumn(
        "coverage_ok", F.coalesce(F.col("unmapped_rate") <= max_unmapped, F.lit(False))
    )


def profile(df: DataFrame, entity: str, date: str) -> DataFrame:
    """Rows, distinct entities, first and last date."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(entity).alias("n_entities"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )


def profile_state(df: DataFrame, entity: str, date: str, measure: str, period: str = "week") -> DataFrame:
    """A profile of each period that merges: rows, first and last date, and sketches of the entities and of a measure.

    The sketches have a fixed size whatever the rows: distinct entities within about 1.6 % (12 bits, one standard error), ranks of
    the measure within about 1.3 %. A run profiles its new period only and adds its row to the stored ones.
    """
    return df.groupBy(F.date_trunc(period, F.col(date)).cast("date").alias("period")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        F.hll_sketch_agg(entity, 12).alias("entities"), F.kll_sketch_agg_double(F.col(measure).cast("double")).alias("measure"),
    )


def merged_profile(states: DataFrame, *groups: str) -> DataFrame:
    """Stored periods as one state (or one for each group); merging is associative, so merged states merge again."""
    return states.groupBy(*groups).agg(
        F.sum("n_rows").alias("n_rows"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.hll_union_agg("entities").alias("entities"), F.kll_merge_agg_double("measure").alias("measure"),
    )


def profile_of(states: DataFrame, ranks: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """Figures of states: rows, about how many entities, first and last date, and the measure at some ranks (null without any)."""
    at = F.array(*[F.lit(float(r)) for r in ranks])
    some = F.kll_sketch_get_n_double("measure") > 0
    return states.withColumns({
        "n_entities": F.hll_sketch_estimate("entities"), "quantiles": F.when(some, F.kll_sketch_get_quantile_double("measure", at)),
    }).drop("entities", "measure")


def count_by(df: DataFrame, *names: str) -> DataFrame:
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def snapshot_quarter(df: DataFrame, text_date: str, by: Sequence[str] = ()) -> DataFrame:
    """Quarter tag of a snapshot, from its earliest readable ``yyyyMMdd`` date."""
    d = F.try_to_date(F.substring(F.trim(F.col(text_date)), 1, 8), "yyyyMMdd")
    return df.groupBy(*by).agg(F.min(d).alias("_first")).select(*by, quarter_tag(F.col("_first")).alias("quarter"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class its rows, the balanced weight n / (k * n_class) and the negative/positive ratio."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    sums = counts.agg(
        F.struct(
            F.sum("n_class").alias("n"),
            F.count(F.lit(1)).alias("k"),
            F.coalesce(F.sum(F.when(F.col(label) == 0, F.col("n_class"))), F.lit(0)).alias("neg"),
            F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("n_class"))), F.lit(0)).alias("pos"),
        ).alias("s")
    )
    return counts.withColumn("_s", sums.scalar()).select(
        label,
        "n_class",
        (F.col("_s.n") / (F.col("_s.k") * F.col("n_class"))).alias("balanced_weight"),
        (F.col("_s.neg") / F.greatest(F.col("_s.pos"), F.lit(1))).alias("scale_pos_weight"),
    )


def with_class_weight(df: DataFrame, label: str, alias: str = "class_weight") -> DataFrame:
    """Attach the balanced weight of a 0/1 label: one scalar subquery, no join."""
    weights = class_weights(df, label).agg(
        F.struct(
            F.max(F.when(F.col(label) == 0, F.col("balanced_weight"))).alias("negative"),
            F.max(F.when(F.col(label) == 1, F.col("balanced_weight"))).alias("positive"),
        ).alias("w")
    )
    return (
        df.withColumn("_w", weights.scalar())
        .withColumn(alias, F.when(F.col(label) == 1, F.col("_w.positive")).when(F.col(label) == 0, F.col("_w.negative")))
        .drop("_w")
    )


def range_anomalies(df: DataFrame, names: Sequence[str], limit: float = MAX_PERCENTAGE) -> DataFrame:
    """Percentage columns whose maximum is beyond any possible value."""
    present = [n for n in names if n in df.columns]
    peaks = df.agg(*[F.max(F.col(n).try_cast("double")).alias(n) for n in present])
    long = peaks.unpivot([], present, "column_name", "max_value")
    return long.filter(F.col("max_value") > limit)
