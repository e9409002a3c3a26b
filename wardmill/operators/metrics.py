"""Model metrics, gate and registry as aggregates over scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill import constants as K
from wardmill.functions.measures import safe_div
from wardmill.operators.dedup import keep_latest
from wardmill.operators.ordered import BUCKETS, all_groups, running_totals


def _regression_columns(y: Column, p: Column) -> list[Column]:
    error = p - y
    # R2 = 1 - SSE / SST with SST = n * population variance: one pass, no cancellation of large sums.
    sse = F.sum(error * error)
    sst = F.var_pop(y) * F.count(y)
    return [
        F.count(F.lit(1)).alias("n_test_rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"),
        (F.avg(F.abs(error) / F.greatest(y, F.lit(0.01))) * 100).alias("mape"),
        F.avg(error).alias("pred_bias"),
    ]


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*_regression_columns(F.col(y), F.col(p)))


def _binary_columns(label: Column, prob: Column, threshold: float) -> list[Column]:
    positive = prob >= threshold
    tp = F.count_if(positive & (label == 1))
    fp = F.count_if(positive & (label == 0))
    fn = F.count_if(~positive & (label == 1))
    zero = F.lit(0.0)
    return [
        F.coalesce(safe_div(tp, tp + fp), zero).alias("precision"),
        F.coalesce(safe_div(tp, tp + fn), zero).alias("recall"),
        F.coalesce(safe_div(tp * 2, tp * 2 + fp + fn), zero).alias("f1"),
    ]


def binary_metrics(
    df: DataFrame, label: str, prob: str, by: Sequence[str] = (), threshold: float = 0.5
) -> DataFrame:
    return df.groupBy(*by).agg(*_binary_columns(F.col(label), F.col(prob), threshold))


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """Exact AUC with half credit for ties; NULL where only one class occurs or no row has a label and a score.

    Scores are folded to distinct values map-side; the negatives below each
    value come from distributed running totals, so no task ranks all rows.
    """
    rows = df.filter(F.col(label).isNotNull())
    totals = running_totals(
        rows,
        by,
        score,
        {"pos": (F.col(label) == 1).cast("bigint"), "neg": (F.col(label) == 0).cast("bigint")},
        buckets=buckets,
    )
    wins = F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return all_groups(df, by, totals.groupBy(*by).agg(safe_div(F.sum(wins), pairs).alias("roc_auc")))


def prediction_summary(
    df: DataFrame, prediction: str, actual: str, strain: str, by: Sequence[str] = ("model_name",),
    threshold: float = K.ALERT_THRESHOLD,
) -> DataFrame:
    n = F.count(F.lit(1))
    alerts = F.count_if(F.col(prediction) >= threshold)
    return df.groupBy(*by).agg(
        n.alias("n_rows"),
        F.avg(prediction).alias("mean_predicted"),
        F.avg(actual).alias("mean_actual"),
        alerts.alias("n_alerts"),
        safe_div(alerts, n).alias("alert_rate"),
        F.avg(F.col(strain).cast("double")).alias("strain_rate"),
        F.avg(F.abs(F.col(actual) - F.col(prediction))).alias("mae"),
    )


def evaluate(
    scored: DataFrame, y: str, p: str, label: str, prob: str, by: Sequence[str] = ("model_name",)
) -> DataFrame:
    """All metrics per model: one aggregate over the rows plus the AUC over distinct scores."""
    alerts = safe_div(F.count_if(F.col(p) >= K.ALERT_THRESHOLD), F.count(F.lit(1))).alias("alert_rate")
    rows = scored.groupBy(*by).agg(
        *_regression_columns(F.col(y), F.col(p)), *_binary_columns(F.col(label), F.col(prob), 0.5), alerts
    )
    return rows.join(roc_auc(scored, label, prob, by), list(by), "left")


def incumbent(registry: DataFrame) -> DataFrame:
    """Newest production entry per model."""
    production = registry.filter(F.col("status") == "production")
    return keep_latest(production, ["model_name"], "create_time").select(
        "model_name", F.col("test_mae").alias("incumbent_mae")
    )


def gate_models(
    metrics: DataFrame,
    incumbents: DataFrame,
    max_mae: float = K.GATE_MAE,
    min_r2: float = K.GATE_R2,
    min_auc: float = K.GATE_AUC,
    tolerance: float = K.GATE_TOLERANCE,
) -> DataFrame:
    """Adds ``gate_failures`` and ``gate_passed``; a NULL AUC or absent incumbent skips that condition."""
    m = metrics.join(incumbents, ["model_name"], "left")
    ceiling = F.col("incumbent_mae") + tolerance
    failures = F.array_compact(F.array(
        F.when(F.col("mae") >= max_mae, "mae"),
        F.when(F.col("r2") <= min_r2, "r2"),
        F.when(F.col("roc_auc") <= min_auc, "roc_auc"),
        F.when(F.col("mae") > ceiling, "incumbent"),
    ))
    return m.withColumn("gate_failures", failures).withColumn("gate_passed", F.size("gate_failures") == 0)


def registry_labels(metrics: DataFrame, train_end: str) -> DataFrame:
    """Metrics as sortable integers and dates as ``yyyymmdd``."""
    return metrics.select(
        "model_name",
        F.lit(train_end.replace("-", "")).alias("train_end_date"),
        F.floor(F.col("mae") * 1000).cast("bigint").alias("test_mae_millimae"),
        F.greatest(F.lit(0), F.col("r2") * 100).cast("bigint").alias("test_r2_centesimal"),
        F.coalesce((F.col("roc_auc") * 100).cast("bigint"), F.lit(0)).alias("test_auc_centesimal"),
        F.col("n_test_rows").cast("bigint").alias("test_rows"),
    )


def evaluation_report(gated: DataFrame, champion: DataFrame, as_of: str, train_end: str, validation_end: str) -> DataFrame:
    """One nested row per model; models that failed the gate carry no status."""
    status = champion.select("model_name", F.col("status").alias("registered_status"))
    return gated.join(status, ["model_name"], "left").select(
        "model_name",
        F.lit(as_of).alias("evaluation_timestamp"),
        "gate_passed",
        "gate_failures",
        "registered_status",
        F.struct(F.lit(train_end).alias("train_end"), F.lit(validation_end).alias("val_end")).alias("train_summary"),
        F.struct(
            "n_test_rows", "mae", "rmse", "r2", "mape", "pred_bias", "precision", "recall", "f1", "roc_auc",
            "alert_rate",
        ).alias("test_metrics"),
    )
