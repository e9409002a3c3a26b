"""Training, scoring and evaluation with MLlib on the prepared panel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.constants import SENTINEL, SENTINEL_COLUMNS
from wardmill.functions.measures import abs_error, clip
from wardmill.operators.aggregates import with_class_weight
from wardmill.operators.prep import Preprocessor, clip_target, fit_preprocessor
from wardmill.operators.shape import align_features, assert_no_leakage, null_sentinels, select_features
from wardmill.plans.features import LABEL, TARGET
from wardmill.session import staging_path


@dataclass(frozen=True)
class BoostingParams:
    """Defaults follow the published training settings; names are MLlib's."""

    maxIter: int = 300
    maxDepth: int = 6
    stepSize: float = 0.05
    subsamplingRate: float = 0.8
    featureSubsetStrategy: str = "0.8"
    minInstancesPerNode: int = 5
    maxBins: int = 64
    seed: int = 42
    checkpointInterval: int = 10

    def as_params(self) -> dict:
        return {f: getattr(self, f) for f in self.__dataclass_fields__}


@dataclass
class CapacityModel:
    name: str
    preprocessor: Preprocessor
    features: list[str]
    regressor: GBTRegressionModel
    classifier: GBTClassificationModel | None = None
    version: str = "unversioned"
    filled: list[str] = field(default_factory=list)

    def matrix(self, df: DataFrame) -> DataFrame:
        """Prepared numeric columns and the vector the trees read."""
        df, self.filled = align_features(null_sentinels(df, SENTINEL_COLUMNS, SENTINEL), self.features)
        return _assembled(self.preprocessor.apply(df), self.features)


MODEL_META = ("name string, version string, features array<string>, numeric array<string>, categorical array<string>, "
              "has_classifier boolean")


def store_preprocessor(prep: Preprocessor, path: str) -> Preprocessor:
    """Write the fitted statistics as small tables and go on from those.

    They are the model's artifact, and every later use reads a few rows instead
    of running the statistics over the training table again.
    """
    def stored(df: DataFrame | None, name: str) -> DataFrame | None:
        if df is None:
            return None
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")

    return Preprocessor(
        prep.numeric, prep.categorical, stored(prep.stats, "numeric"), stored(prep.mode_table, "modes"),
        stored(prep.codes, "codes"),
    )


def save_model(model: CapacityModel, path: str) -> None:
    """Trees by MLlib's writers, statistics as tables, names and version as one JSON row."""
    prep = store_preprocessor(model.preprocessor, f"{path}/preprocessor")
    model.regressor.write().overwrite().save(f"{path}/regressor")
    if model.classifier is not None:
        model.classifier.write().overwrite().save(f"{path}/classifier")
    row = (model.name, model.version, list(model.features), list(prep.numeric), list(prep.categorical), model.classifier is not None)
    SparkSession.active().createDataFrame([row], MODEL_META).coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> CapacityModel:
    meta = spark.read.schema(MODEL_META).json(f"{path}/meta").first()
    table = lambda name, there: spark.read.parquet(f"{path}/preprocessor/{name}") if there else None
    prep = Preprocessor(
        tuple(meta["numeric"]), tuple(meta["categorical"]), table("numeric", meta["numeric"]), table("modes", meta["categorical"]),
        table("codes", meta["categorical"]),
    )
    classifier = GBTClassificationModel.load(f"{path}/classifier") if meta["has_classifier"] else None
    return CapacityModel(meta["name"], prep, list(meta["features"]), GBTRegressionModel.load(f"{path}/regressor"), classifier, meta["version"])


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep").transform(df)


def training_rows(df: DataFrame) -> DataFrame:
    """Rows with a target, clipped to [0, 1]; ``split`` comes from ``temporal_split``."""
    return clip_target(df.filter(F.col(TARGET).isNotNull()), TARGET)


def train_model(
    df: DataFrame, name: str, params: BoostingParams = BoostingParams(), with_classifier: bool = True,
    early_stopping: bool = False, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None,
    version: str = "unversioned", artifacts: str | None = None,
) -> CapacityModel:
    """Regressor for the next-week rate and classifier for high strain.

    The preprocessor is fitted on ``split = 'train'`` only and stored under
    ``artifacts`` (the shared folder if not given). ``early_stopping``
    watches the validation rows. MLlib grows its trees over partitions with
    tree aggregation; the prepared rows are cached for the iterations and can
    be recomputed from their lineage when an executor is lost.
    """
    if numeric is None or categorical is None:
        found = select_features([n for n in df.columns if n != "split"])
        numeric = found[0] if numeric is None else list(numeric)
        categorical = found[1] if categorical is None else list(categorical)
    features = [*numeric, *categorical]
    assert_no_leakage(features)
    rows = null_sentinels(training_rows(df), SENTINEL_COLUMNS, SENTINEL)
    fitted = fit_preprocessor(rows.filter(F.col("split") == "train"), numeric, categorical)
    prep = store_preprocessor(fitted, artifacts or staging_path(df.sparkSession, f"preprocessor-{name}"))
    used = ["train", "val"] if early_stopping else ["train"]
    prepared = _assembled(prep.apply(rows.filter(F.col("split").isin(used))), features)
    prepared = prepared.select("features", TARGET, LABEL, (F.col("split") == "val").alias("is_validation")).persist()
    try:
        extra = {"validationIndicatorCol": "is_validation"} if early_stopping else {}
        regressor = GBTRegressor(
            featuresCol="features", labelCol=TARGET, predictionCol="prediction", **extra, **params.as_params()
        ).fit(prepared)
        classifier = None
        if with_classifier:
            weighted = with_class_weight(prepared.filter(F.col(LABEL).isNotNull()), LABEL)
            classifier = GBTClassifier(
                featuresCol="features", labelCol=LABEL, weightCol="class_weight", **extra, **params.as_params()
            ).fit(weighted)
    finally:
        prepared.unpersist()
    return CapacityModel(name, prep, features, regressor, classifier, version)


def score(model: CapacityModel, df: DataFrame, run_date: str, data_source: str = "feature_weekly") -> DataFrame:
    """Predictions per row, rounded and clipped, with actuals where they are known."""
    c = F.col
    carried = [n for n in (TARGET, LABEL) if n in df.columns]
    actuals = {n: c(n) for n in carried}
    scored = model.regressor.transform(model.matrix(df.withColumns({f"_actual_{n}": v for n, v in actuals.items()})
                                                    if carried else df))
    prediction = clip(c("prediction"), 0.0, 1.0)
    out = scored.withColumn("_raw_prediction", prediction).drop("prediction")
    if model.classifier is not None:
        out = model.classifier.transform(out)
        probability = F.element_at(vector_to_array(c("probability")), 2)
        label = c("prediction").cast("bigint")
    else:
        probability, label = F.lit(None).cast("double"), F.lit(None).cast("bigint")
    actual = c(f"_actual_{TARGET}") if TARGET in carried else F.lit(None).cast("double")
    strain = c(f"_actual_{LABEL}").cast("bigint") if LABEL in carried else F.lit(None).cast("bigint")
    return out.select(
        F.lit(model.name).alias("model_name"),
        c("hospital_id").cast("string").alias("hospital_id"),
        c("report_date").cast("date").alias("report_date"),
        F.lit(run_date).cast("date").alias("run_date"),
        F.round("_raw_prediction", 4).alias("pred_occupancy_next_week"),
        label.alias("pred_high_strain"),
        F.round(probability, 4).alias("pred_high_strain_prob"),
        F.round(actual, 4).alias("actual_occupancy"),
        strain.alias("actual_high_strain"),
        abs_error(actual, c("_raw_prediction")).alias("abs_error"),
        F.lit(model.version).alias("model_version"),
        F.lit(data_source).alias("data_source"),
        "features",
        c("_raw_prediction").alias("raw_prediction"),
    )
