"""Per-row attribution of a prediction to its features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contribution_array(parts: Mapping[str, Column]) -> Column:
    """Array of (feature, value), in feature order."""
    return F.array(*[
        F.struct(F.lit(n).alias("feature"), c.cast("double").alias("value")) for n, c in parts.items()
    ])


def linear_contributions(
    df: DataFrame, coefficients: Mapping[str, Column | float], means: Mapping[str, Column | float],
    intercept: Column | float, alias: str = "contributions",
) -> DataFrame:
    """Exact contributions of a linear model: ``coef * (x - mean)``, base = prediction at the means."""
    def column(v: Column | float) -> Column:
        return v if isinstance(v, Column) else F.lit(float(v))

    parts = {n: column(k) * (F.col(n) - column(means[n])) for n, k in coefficients.items()}
    base = column(intercept)
    for n, k in coefficients.items():
        base = base + column(k) * column(means[n])
    return df.withColumns({alias: contribution_array(parts), "shap_base_value": base})


def strongest(contributions: Column, n: int) -> Column:
    """The n entries of largest absolute value; of equal ones the later feature comes first."""
    indexed = F.transform(
        contributions,
        lambda e, i: F.struct(F.abs(e["value"]).alias("size"), i.alias("position"), e["feature"].alias("feature"),
                              e["value"].alias("value")),
    )
    return F.slice(F.sort_array(indexed, asc=False), 1, n)


def top_contributions(df: DataFrame, contributions: str = "contributions", n: int = 3) -> DataFrame:
    """Adds ``topK_feature``, ``topK_shap``, ``topK_direction`` and a readable ``explanation``."""
    ranked = df.withColumn("_top", strongest(F.col(contributions), n))
    columns: dict[str, Column] = {}
    texts = []
    for k in range(1, n + 1):
        entry = F.try_element_at(F.col("_top"), F.lit(k))
        direction = F.when(entry["value"] > 0, "up").when(entry["value"].isNotNull(), "down")
        columns[f"top{k}_feature"] = entry["feature"]
        columns[f"top{k}_shap"] = F.round(entry["value"], 4)
        columns[f"top{k}_direction"] = direction
        texts.append(F.concat(entry["feature"], F.lit(" ("), direction, F.lit(" "), _three_digits(entry["size"]), F.lit(")")))
    columns["explanation"] = F.concat_ws(", ", *texts)
    return ranked.withColumns(columns).drop("_top")


def _three_digits(c: Column) -> Column:
    """``%.3f`` by way of a decimal, many times cheaper than a formatter, which stays for huge values."""
    return F.coalesce(c.try_cast("decimal(38,3)").cast("string"), F.format_string("%.3f", c))


def to_serving_columns(df: DataFrame, n: int = 3) -> DataFrame:
    names = {f"top{k}_feature": f"shap_feature_{k}" for k in range(1, n + 1)}
    names |= {f"top{k}_shap": f"shap_value_{k}" for k in range(1, n + 1)}
    return df.withColumnsRenamed(names)


def raw_output_columns(n: int = 3) -> Sequence[str]:
    return [f"top{k}_{s}" for k in range(1, n + 1) for s in ("feature", "shap", "direction")] + ["explanation"]
