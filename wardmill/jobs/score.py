"""Train, evaluate and score on the feature store, then publish monitoring and serving tables."""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill import schemas
from wardmill.constants import (
    GATE_MAE,
    MIN_ROWS_PER_SPLIT,
    MIN_TRAINING_ROWS,
    PRIMARY_MODEL,
    TRAIN_END,
    VALIDATION_END,
)
from wardmill.operators.attribution import top_contributions
from wardmill.operators.dedup import keep_first, latest_snapshot, pick_champion
from wardmill.operators.incremental import freshness, has_new_data
from wardmill.operators.metrics import evaluate, evaluation_report, gate_models, incumbent, registry_labels
from wardmill.operators.panel import temporal_split
from wardmill.operators.quality import (
    check_forecast,
    check_observability,
    check_predictions,
    enforce_checks,
    enforce_min_rows,
    reconcile,
    validate_panel,
)
from wardmill.operators.shape import conform, require_features, stack
from wardmill.plans.explain import with_shapley_contributions
from wardmill.plans.features import LABEL, TARGET
from wardmill.plans.models import BoostingParams, CapacityModel, load_model, save_model, score, train_model
from wardmill.plans.params import RunParams
from wardmill.plans.serving import forecast_enriched, forecast_latest, forecast_serving, observability
from wardmill.session import build_session, ensure_checkpoint_dir, path_exists
from wardmill.sources.writers import append_newer, land, split_counts, upsert_partitions, write_feature_metadata, write_run, write_splits

REGISTRY = "model_name string, status string, create_time timestamp, test_mae double"


def train(
    spark: SparkSession, features: DataFrame, params: RunParams, out: str,
    models: Mapping[str, BoostingParams], train_end: str = TRAIN_END, validation_end: str = VALIDATION_END,
    min_rows: int = MIN_ROWS_PER_SPLIT, min_training: int = MIN_TRAINING_ROWS,
) -> dict[str, CapacityModel]:
    """Validate, split, fit, evaluate on the test rows, gate and register."""
    ensure_checkpoint_dir(spark)
    keys = ["hospital_id", "report_date"]
    report = validate_panel(features, keys, [TARGET, LABEL]).first()
    if not report["panel_ok"]:
        raise ValueError(f"feature panel is not usable: {report}")
    rows = temporal_split(keep_first(features, keys), "report_date", train_end, validation_end)
    counts = split_counts(rows)
    enforce_min_rows({n: counts[n] for n in ("val", "test")}, min_rows)
    enforce_min_rows({"train": counts["train"]}, min_training)
    write_splits(rows, f"{out}/splits", features.columns, [TARGET, LABEL])
    rows = spark.read.parquet(f"{out}/splits")
    fitted = {
        name: train_model(rows, name, p, early_stopping=name != PRIMARY_MODEL, version=f"{name}@{params.run_date}",
                          artifacts=f"{out}/preprocessor/{name}")
        for name, p in models.items()
    }
    some = next(iter(fitted.values())).preprocessor
    write_feature_metadata(spark, f"{out}/feature_metadata", some.numeric, some.categorical, train_end, validation_end, counts)
    for name, model in fitted.items():
        save_model(model, f"{out}/models/{name}/{params.run_date}")
    test = rows.filter(F.col("split") == "test")
    scored = stack([score(m, test, params.run_date).drop("features") for m in fitted.values()])
    metrics = evaluate(scored, "actual_occupancy", "raw_prediction", "actual_high_strain", "pred_high_strain_prob")
    registry_path = f"{out}/registry"
    registry = (
        spark.read.schema(REGISTRY).parquet(registry_path) if path_exists(spark, registry_path)
        else spark.createDataFrame([], REGISTRY)
    )
    land(gate_models(metrics, incumbent(registry)), f"{out}/metrics")
    gated = spark.read.parquet(f"{out}/metrics")
    champion = pick_champion(gated.filter("gate_passed"), PRIMARY_MODEL)
    evaluation_report(gated, champion, params.run_date, train_end, validation_end).write.mode("overwrite").json(
        f"{out}/evaluation"
    )
    registry_labels(gated, train_end).write.mode("overwrite").json(f"{out}/labels")
    if champion.isEmpty():
        raise RuntimeError(f"no model passed the gate (MAE below {GATE_MAE}); nothing was registered")
    if not params.dry_run:
        champion.select(
            "model_name", "status", F.lit(params.run_date).cast("timestamp").alias("create_time"),
            F.col("mae").alias("test_mae"),
        ).write.mode("append").parquet(registry_path)
    return fitted


def registered_models(spark: SparkSession, out: str) -> dict[str, CapacityModel]:
    """The newest registered version of each model, read back from its files."""
    registry = spark.read.schema(REGISTRY).parquet(f"{out}/registry")
    newest = registry.groupBy("model_name").agg(F.max("create_time").cast("date").cast("string").alias("day")).collect()
    return {r["model_name"]: load_model(spark, f"{out}/models/{r['model_name']}/{r['day']}") for r in newest}


def publish(
    spark: SparkSession, features: DataFrame, hospitals: DataFrame, models: Mapping[str, CapacityModel] | None,
    params: RunParams, out: str,
) -> bool:
    """Score the newest snapshot per facility and replace this run in the three tables.

    Without ``models`` the registered ones are loaded. A feature table that lacks a column of a model stops the run.
    """
    day = params.run_date
    models = registered_models(spark, out) if models is None else models
    for model in models.values():
        require_features([n for n in model.features if n in features.columns], model.features)
    enforce_checks(freshness(features, "report_date", day).first())
    raw_path = f"{out}/prediction_raw"
    ddl = schemas.PREDICTION_RAW
    if path_exists(spark, raw_path):
        done = spark.read.schema(schemas.struct(ddl)).parquet(raw_path)
        if not has_new_data(features, done, day).first()["has_new_data"]:
            return False
    snapshot = latest_snapshot(features, "hospital_id", "report_date", day, params.lookback_days)
    parts = []
    for model in models.values():
        scored = with_shapley_contributions(score(model, snapshot, day), model.regressor, model.features)
        parts.append(conform(
            top_contributions(scored).withColumn("predicted_at", F.lit(day).cast("timestamp")), ddl
        ))
    raw = stack(parts)
    if params.dry_run:
        return True
    write_run(raw, raw_path, cluster=["model_name", "hospital_id"], required=schemas.required_columns(ddl),
              disposition=params.write_disposition)
    raw = spark.read.schema(schemas.struct(ddl)).parquet(raw_path)
    enforce_checks(check_predictions(raw, day).first())
    write_run(observability(raw, day), f"{out}/observability", cluster=["model_name", "hospital_id"])
    write_run(forecast_serving(raw, hospitals, day), f"{out}/forecast", cluster=["state", "hospital_id"])
    seen, served = (spark.read.parquet(f"{out}/{n}") for n in ("observability", "forecast"))
    enforce_checks(check_observability(seen, day).first())
    enforce_checks(check_forecast(served, day).first())
    enforce_checks(reconcile(raw, seen, served, day).select("observability_ok", "serving_ok").first())
    return True


def serve(spark: SparkSession, hospitals: DataFrame, geography: DataFrame, out: str) -> None:
    """The serving tables: new runs are appended to the latest forecasts, late runs merged into the dashboard's rows."""
    served = spark.read.parquet(f"{out}/forecast")
    append_newer(forecast_latest(served.drop("forecast_id"), hospitals), f"{out}/forecast_latest", "run_date")
    path = f"{out}/forecast_enriched"
    target = spark.read.parquet(path) if path_exists(spark, path) else None
    batch = forecast_enriched(served, hospitals, geography, target).filter(F.col("forecast_date").isNotNull())
    upsert_partitions(spark, path, batch, ["hospital_id", "forecast_date"], "forecast_date")


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("run_date")
    parser.add_argument("--gold", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--lookback-days", type=int, default=40)
    parser.add_argument("--dry-run", action="store_true")
    args = parser.parse_args()
    spark = build_session("score")
    params = RunParams(args.run_date, args.lookback_days, dry_run=args.dry_run)
    features = spark.read.parquet(f"{args.gold}/feature_weekly")
    hospitals = spark.read.parquet(f"{args.gold}/dim_hospital")
    settings = {PRIMARY_MODEL: BoostingParams(), "LightGBM": BoostingParams(minInstancesPerNode=20)}
    train(spark, features, params, args.out, settings)
    if publish(spark, features, hospitals, None, params, args.out) and not params.dry_run:
        serve(spark, hospitals, spark.read.parquet(f"{args.gold}/dim_geography"), args.out)
    spark.stop()


if __name__ == "__main__":
    main()
