"""Preprocessing for models: fitted statistics are DataFrames, applying them plans no cross join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.constants import HIGH_STRAIN_OCCUPANCY
from wardmill.functions.measures import clip
from wardmill.operators.ordered import dense_codes, running_totals


def _long(df: DataFrame, names: Sequence[str], dtype: str) -> DataFrame:
    return df.select(*[F.col(n).cast(dtype).alias(n) for n in names]).unpivot([], list(names), "feature", "value")


def _summary(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: row count and, per column, present values, moments and a narrow band around the median.

    The sketch behind ``percentile_approx`` misplaces a value by at most one
    ten-thousandth of the rows here; ``numeric_stats`` checks that the band
    holds the median.
    """
    fields = ", ".join(
        f"'{n}', named_struct('present', count(`{n}`), 'mean', CAST(avg(`{n}`) AS DOUBLE), "
        f"'var', CAST(var_pop(`{n}`) AS DOUBLE), "
        f"'band', percentile_approx(CAST(`{n}` AS DOUBLE), array(0.495D, 0.505D), 10000))"
        for n in names
    )
    return df.agg(F.expr(f"named_struct('n', count(1), 'of', named_struct({fields})) AS summary"))


def _band_counts(df: DataFrame, summary: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, value, n) inside each band; everything below a band is one row with a NULL value.

    Counted map-side, so about one percent of the values is shuffled instead of
    the whole table once per column.
    """
    entries = ", ".join(
        f"named_struct('feature', '{n}', 'value', CAST(`{n}` AS DOUBLE), 'band', _summary.of.`{n}`.band)"
        for n in names
    )
    long = df.withColumn("_summary", summary.scalar()).select(F.expr(f"inline(array({entries}))"))
    inside = long.filter("value IS NOT NULL AND value <= band[1]")
    return inside.groupBy("feature", F.expr("CASE WHEN value >= band[0] THEN value END").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def numeric_stats(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, median, mean, deviation): moments of the column after median imputation.

    Exact median, population deviation. Two scans: one for the summary row,
    which also yields the moments of the imputed column, one for the band.
    """
    summary = _summary(df, names)
    counts = _band_counts(df, summary, names)
    below = counts.filter("value IS NULL").select("feature", F.col("n").alias("below"))
    band = running_totals(counts, ["feature"], "value", {"n": F.col("n")})
    per_feature = summary.select(F.expr("inline(array(" + ", ".join(
        f"named_struct('feature', '{n}', 'n', summary.n, 'present', summary.of.`{n}`.present, "
        f"'mean', summary.of.`{n}`.mean, 'var', summary.of.`{n}`.var)" for n in names
    ) + "))"))
    sizes = per_feature.select("feature", "present").join(below, ["feature"], "left")
    # One row per feature: its size is that of the schema.
    placed = band.join(F.broadcast(sizes), ["feature"]).withColumn("last", F.expr("cum_n + coalesce(below, 0)"))
    medians = placed.withColumn("first", F.expr("last - n + 1")).groupBy("feature").agg(
        F.expr("(max(CASE WHEN floor((present + 1) / 2) BETWEEN first AND last THEN value END)"
               " + max(CASE WHEN floor((present + 2) / 2) BETWEEN first AND last THEN value END)) / 2").alias("median")
    )
    return (
        per_feature.join(medians, ["feature"], "left")
        .withColumn("imputed", F.expr("(present * coalesce(mean, 0D) + (n - present) * coalesce(median, 0D)) / n"))
        .withColumn("spread", F.expr(
            "(present * (coalesce(var, 0D) + pow(coalesce(mean, 0D) - imputed, 2))"
            " + (n - present) * pow(coalesce(median, 0D) - imputed, 2)) / n"
        ))
        # The median's rank was counted; a band that misses it is an error, never a NULL.
        .withColumn("median", F.expr(
            "CASE WHEN present > 0 AND median IS NULL THEN CAST(raise_error(concat('no median in the band of ', feature))"
            " AS DOUBLE) ELSE median END"
        ))
        .selectExpr("feature", "median", "CASE WHEN median IS NOT NULL THEN imputed END AS mean",
                    "CASE WHEN median IS NOT NULL THEN sqrt(spread) END AS deviation")
    )


def modes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, mode): most frequent value, the smallest one on a tie."""
    counts = (
        _long(df, names, "string").filter(F.col("value").isNotNull())
        .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("feature").agg(
        F.min_by(F.col("value"), F.struct(-F.col("n"), F.col("value"))).alias("mode")
    )


def category_codes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, value, code): 0-based position of each category in sorted order."""
    return dense_codes(_long(df, names, "string"), ["feature"], "value")


@dataclass(frozen=True)
class Preprocessor:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    stats: DataFrame | None
    mode_table: DataFrame | None
    codes: DataFrame | None

    def apply(self, df: DataFrame) -> DataFrame:
        """Numeric: impute and standardise. Categorical: impute and encode, unknown is -1.

        Statistics enter as one struct from a scalar subquery (one field per
        column); only the category codes, which can be many, are joined.
        """
        out = df
        if self.numeric:
            fields = ", ".join(
                f"'{n}', max(CASE WHEN feature = '{n}' THEN named_struct('median', median, 'mean', mean, "
                f"'scale', CASE WHEN deviation > 0 THEN deviation ELSE 1D END) END)"
                for n in self.numeric
            )
            out = out.withColumn("_stats", self.stats.agg(F.expr(f"named_struct({fields}) AS stats")).scalar())
            out = out.withColumns({
                n: F.expr(f"(coalesce(CAST(`{n}` AS DOUBLE), _stats.`{n}`.median) - _stats.`{n}`.mean)"
                          f" / _stats.`{n}`.scale")
                for n in self.numeric
            }).drop("_stats")
        if self.categorical:
            row = self.mode_table.agg(F.struct(*[
                F.max(F.when(F.col("feature") == n, F.col("mode"))).alias(n) for n in self.categorical
            ]).alias("row"))
            out = out.withColumn("_modes", row.scalar())
            out = out.withColumns({
                n: F.coalesce(F.col(n).cast("string"), F.col("_modes")[n]) for n in self.categorical
            }).drop("_modes")
            for n in self.categorical:
                table = self.codes.filter(F.col("feature") == n).select(
                    F.col("value").alias(n), F.col("code").alias(f"_code_{n}")
                )
                out = out.join(table, [n], "left").withColumn(
                    n, F.coalesce(F.col(f"_code_{n}"), F.lit(-1)).cast("double")
                ).drop(f"_code_{n}")
        return out.select(*df.columns)


def fit_preprocessor(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Preprocessor:
    """Statistics of the training rows only; lazy, no job runs here."""
    return Preprocessor(
        tuple(numeric),
        tuple(categorical),
        numeric_stats(train, numeric) if numeric else None,
        modes(train, categorical) if categorical else None,
        category_codes(train, categorical) if categorical else None,
    )


def clip_target(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn(target, clip(F.col(target), 0.0, 1.0))


def ensure_label(
    df: DataFrame, target: str, label: str, threshold: float = HIGH_STRAIN_OCCUPANCY
) -> DataFrame:
    """Rebuild the 0/1 label from the target where the frame has none."""
    if label in df.columns:
        return df
    return df.withColumn(label, (F.col(target) >= threshold).cast("int"))
