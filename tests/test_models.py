from __future__ import annotations

import datetime
import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardmill.operators import metrics as M
from wardmill.operators import prep as P
from wardmill.operators import quality as Q
from wardmill.operators.aggregates import class_weights, range_anomalies, with_class_weight
from wardmill.operators.attribution import linear_contributions, to_serving_columns, top_contributions
from wardmill.operators.shape import align_features, assert_no_leakage, require_features, select_features
from wardmill.plans.explain import with_path_contributions
from wardmill.plans.features import FEATURE_COLUMNS, LABEL, TARGET
from wardmill.plans.models import BoostingParams, score, train_model

c = F.col


def scored(spark):
    data = [("a", 0.0, 0.1, 0, 0.1), ("a", 0.5, 0.4, 0, 0.4), ("a", 1.0, 0.9, 1, 0.35), ("a", 0.5, 0.7, 1, 0.8),
            ("b", 0.5, 0.5, 0, 0.2), ("b", 0.5, 0.6, 0, 0.3)]
    return spark.createDataFrame(data, "model_name string, y double, p double, label int, prob double")


def test_metrics_by_hand(spark):
    got = {r["model_name"]: r for r in M.evaluate(scored(spark), "y", "p", "label", "prob").collect()}
    a, b = got["a"], got["b"]
    y, p = np.array([0, 0.5, 1, 0.5]), np.array([0.1, 0.4, 0.9, 0.7])
    e = p - y
    assert a["mae"] == pytest.approx(np.abs(e).mean()) and a["rmse"] == pytest.approx(math.sqrt((e ** 2).mean()))
    assert a["r2"] == pytest.approx(1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert a["mape"] == pytest.approx((np.abs(e) / np.clip(y, 0.01, None)).mean() * 100)
    assert a["pred_bias"] == pytest.approx(e.mean()) and a["alert_rate"] == 0.25
    assert (a["precision"], a["recall"], a["roc_auc"]) == (1.0, 0.5, 0.75) and a["f1"] == pytest.approx(2 / 3)
    assert (b["roc_auc"], b["precision"], b["recall"], b["f1"], b["r2"]) == (None, 0.0, 0.0, 0.0, None)


def test_gate(spark):
    metrics = spark.createDataFrame([
        ("good", 0.05, 0.9, 0.9), ("no auc", 0.05, 0.9, None), ("edge", 0.055, 0.9, 0.9), ("worse", 0.0551, 0.9, 0.9),
        ("bad", 0.10, 0.75, 0.85),
    ], "model_name string, mae double, r2 double, roc_auc double")
    registry = spark.createDataFrame([
        ("edge", "production", datetime.datetime(2024, 1, 2), 0.05), ("edge", "production", datetime.datetime(2024, 1, 1), 0.01),
        ("worse", "production", datetime.datetime(2024, 1, 1), 0.05), ("worse", "candidate", datetime.datetime(2024, 2, 1), 0.9),
    ], "model_name string, status string, create_time timestamp, test_mae double")
    gated = M.gate_models(metrics, M.incumbent(registry))
    got = {r["model_name"]: (r["gate_passed"], r["gate_failures"]) for r in gated.collect()}
    assert got == {
        "good": (True, []), "no auc": (True, []), "edge": (True, []), "worse": (False, ["incumbent"]),
        "bad": (False, ["mae", "r2", "roc_auc"]),
    }


def test_registry_labels_truncate(spark):
    df = spark.createDataFrame([("m", 0.0689, -0.5, None, 10)], "model_name string, mae double, r2 double, roc_auc double, n_test_rows long")
    assert rows(M.registry_labels(df, "2022-12-31")) == [("m", "20221231", 68, 0, 0, 10)]


def test_attribution_ties_zero_and_short_vectors(spark):
    ddl = "i int, contributions array<struct<feature:string,value:double>>"
    df = spark.createDataFrame([
        (1, [("a", 0.5), ("b", -0.5), ("c", 0.1), ("d", 0.0)]), (2, [("a", 0.0)]), (3, []),
    ], ddl)
    got = {r["i"]: r for r in top_contributions(df).collect()}
    assert [got[1][f"top{k}_feature"] for k in (1, 2, 3)] == ["b", "a", "c"]
    assert [got[1][f"top{k}_direction"] for k in (1, 2, 3)] == ["down", "up", "up"]
    assert got[1]["explanation"] == "b (down 0.500), a (up 0.500), c (up 0.100)"
    assert (got[2]["top1_direction"], got[2]["top2_feature"], got[2]["top2_direction"]) == ("down", None, None)
    assert got[3]["explanation"] == ""
    assert {"shap_feature_1", "shap_value_3"} <= set(to_serving_columns(top_contributions(df)).columns)


def test_linear_contributions_add_up(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, -3.0)], "x double, z double")
    got = linear_contributions(df, {"x": 2.0, "z": -1.0}, {"x": 1.5, "z": 1.0}, 0.25).collect()
    for r in got:
        total = r["shap_base_value"] + sum(e["value"] for e in r["contributions"])
        assert total == pytest.approx(0.25 + 2 * r["x"] - r["z"])


def test_preprocessing_equals_numpy(spark):
    rng = np.random.default_rng(5)
    n = 3000
    x = np.where(rng.random(n) < 0.3, np.nan, np.where(rng.random(n) < 0.4, 7.0, rng.normal(0, 10, n)))
    cat = [None if v < 0.1 else f"k{int(v * 9)}" for v in rng.random(n)]
    data = [(i, None if math.isnan(v) else float(v), 3.0, k, None) for i, (v, k) in enumerate(zip(x, cat))]
    df = spark.createDataFrame(data, "i int, x double, flat double, k string, empty double").repartition(5)
    train = df.filter("i < 2000")
    got = P.fit_preprocessor(train, ["x", "flat", "empty"], ["k"]).apply(df).toPandas().sort_values("i")
    xt = x[:2000]
    med = np.nanmedian(xt)
    filled = np.where(np.isnan(xt), med, xt)
    stats = {r["feature"]: r for r in P.numeric_stats(train, ["x", "flat", "empty"]).collect()}
    assert stats["x"]["median"] == med and stats["empty"]["median"] is None
    want = (np.where(np.isnan(x), med, x) - filled.mean()) / filled.std()
    assert np.allclose(got["x"].to_numpy(), want)
    assert (got["flat"] == 0).all() and got["empty"].isna().all()
    known = sorted({k for k in cat[:2000] if k})
    counts = {k: cat[:2000].count(k) for k in known}
    mode = min(known, key=lambda k: (-counts[k], k))
    assert got["k"].tolist() == [float(known.index(k or mode)) if (k or mode) in known else -1.0 for k in cat]


def test_unknown_category_is_minus_one(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z")], "i int, k string")
    got = P.fit_preprocessor(df.filter("i < 3"), [], ["k"]).apply(df)
    assert rows(got, "i") == [(1, 0.0), (2, 1.0), (3, -1.0)]


def test_feature_selection_and_guards(spark):
    numeric, categorical = select_features(FEATURE_COLUMNS)
    assert categorical == ["state", "season", "disease_season", "healthcare_risk_level", "hospital_type", "metro_nonmetro_flag",
                           "hrr_region"]
    assert "occ_lag1" in numeric and "occupancy_rate" not in numeric and TARGET not in numeric
    assert_no_leakage([*numeric, *categorical])
    with pytest.raises(ValueError):
        assert_no_leakage(["occ_lag1", "Target_x"])
    with pytest.raises(ValueError, match="absent: \\['b'\\]"):
        require_features(["a"], ["a", "b"])
    df, missing = align_features(spark.createDataFrame([(1.0,)], "a double"), ["a", "b"])
    assert missing == ["b"] and df.first()["b"] is None


def test_labels_and_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)] + [(None,)], "y int")
    got = {r["y"]: (r["balanced_weight"], r["scale_pos_weight"]) for r in class_weights(df, "y").collect()}
    assert got == {0: (4 / 6, 3.0), 1: (2.0, 3.0)}
    assert {r["y"]: r["class_weight"] for r in with_class_weight(df, "y").collect()} == {0: 4 / 6, 1: 2.0, None: None}
    only = class_weights(df.filter("y = 0"), "y").first()
    assert only["scale_pos_weight"] == 3.0
    made = P.ensure_label(spark.createDataFrame([(0.85,), (0.849,), (None,)], "t double"), "t", "label")
    assert [r["label"] for r in made.collect()] == [1, 0, None]


def test_panel_report_and_assertions(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, None), (None, 2, 1.0)], "h string, d int, t double")
    r = Q.validate_panel(df, ["h", "d"], ["t"]).first()
    assert (r["n_rows"], r["n_duplicates"], r["panel_ok"]) == (3, 1, False)
    assert not Q.validate_panel(df.filter("d > 9"), ["h", "d"], ["t"]).first()["panel_ok"]
    assert rows(Q.assert_unique(df, ["h", "d"])) == [("a", 1, 2)]
    assert Q.assert_not_null(df, ["h", "t"]).count() == 2
    assert Q.duplicate_count(df.filter("d > 9"), ["h"]).first()["n_duplicates"] == 0
    with pytest.raises(ValueError):
        Q.enforce_min_rows({"val": 3, "test": 700}, 500)
    with pytest.raises(ValueError, match="ok"):
        Q.enforce_checks(spark.sql("SELECT 1 AS fine, 0 AS ok").first())
    odd = spark.createDataFrame([("150", "x"), ("9900", "y")], "a string, b string")
    assert rows(range_anomalies(odd, ["a", "b", "absent"])) == [("a", 9900.0)]


@pytest.fixture(scope="module")
def training(spark):
    """Next week's rate depends on the last one and on the season; derived by Spark from a range."""
    i = c("id")
    level = 0.5 + 0.4 * F.sin(i % 53 / 8.0)
    noise = (F.hash("id") % 100) / 4000
    df = spark.range(3000).select(
        (i % 40).cast("string").alias("hospital_id"),
        F.date_add(F.lit("2022-01-01").cast("date"), (i / 5).cast("int")).alias("report_date"),
        (level + noise).alias("occ_lag1"), F.when(i % 7 != 0, level).alias("occ_roll4"),
        F.when(i % 2 == 0, "Winter").otherwise("Summer").alias("season"),
        F.least(level + F.when(i % 2 == 0, 0.1).otherwise(0.0), F.lit(1.2)).alias(TARGET),
    )
    part = F.abs(F.hash("hospital_id", "report_date")) % 10
    return df.withColumn(LABEL, (c(TARGET) > 0.85).cast("int")).withColumn(
        "split", F.when(part < 6, "train").when(part < 8, "val").otherwise("test")
    )


@pytest.fixture(scope="module")
def model(training):
    params = BoostingParams(maxIter=6, maxDepth=3, stepSize=0.3, maxBins=16)
    return train_model(training, "XGBoost", params, early_stopping=True, version="v1")


def test_training_beats_the_mean_and_stays_in_range(training, model):
    test = training.filter("split = 'test'")
    got = score(model, test, "2024-01-01").cache()
    pdf = got.toPandas()
    assert model.features == ["occ_lag1", "occ_roll4", "season"]
    assert pdf["pred_occupancy_next_week"].between(0, 1).all() and pdf["pred_high_strain_prob"].between(0, 1).all()
    mean = training.filter("split = 'train'").agg(F.avg(F.least(c(TARGET), F.lit(1.0)))).first()[0]
    actual = pdf["actual_occupancy"].clip(0, 1)
    assert (pdf["raw_prediction"] - actual).abs().mean() < 0.3 * (actual - mean).abs().mean()
    agree = (pdf["pred_high_strain"] == pdf["actual_high_strain"]).mean()
    assert agree > 0.9 and set(pdf["model_version"]) == {"v1"}


def test_scoring_without_actuals_and_with_absent_columns(training, model):
    got = score(model, training.drop(TARGET, LABEL, "occ_roll4"), "2024-01-01")
    row = got.first()
    assert row["actual_occupancy"] is None and row["abs_error"] is None and row["actual_high_strain"] is None
    assert model.filled == ["occ_roll4"]


def test_path_contributions_add_up_to_the_prediction(training, model):
    scored_rows = score(model, training.filter("split = 'test'"), "2024-01-01")
    plain = model.regressor.transform(model.matrix(training.filter("split = 'test'")))
    want = {(r["hospital_id"], r["report_date"]): r["prediction"] for r in plain.select("hospital_id", "report_date", "prediction").collect()}
    got = with_path_contributions(scored_rows, model.regressor, model.features)
    base = sum(w * t for w, t in zip(model.regressor.treeWeights,
                                     [t.rootNode().prediction() for t in model.regressor._java_obj.trees()]))
    checked = 0
    for r in got.select("hospital_id", "report_date", "contributions").collect():
        total = base + sum(e["value"] for e in r["contributions"])
        checked += abs(total - want[r["hospital_id"], r["report_date"]]) < 1e-9
    assert checked == got.count() > 0


def test_training_is_repeatable(training, model):
    again = train_model(training, "XGBoost", BoostingParams(maxIter=6, maxDepth=3, stepSize=0.3, maxBins=16),
                        with_classifier=False, early_stopping=True)
    trees = lambda m: m.regressor.toDebugString.split("\n", 1)[1]
    assert trees(again) == trees(model)


def test_snapshot_check_judges_new_weeks_and_exact_sums(spark, monkeypatch):
    from wardmill.checks import models as K

    score, explain = K.score, K.with_shapley_contributions
    late = F.when(F.col("report_date") > "2001-03-31", 1.0)

    def worse_on_new_weeks(*args):
        return score(*args).withColumn("abs_error", late.otherwise(F.col("abs_error")))

    def nearly(*args):
        moved = F.transform("contributions", lambda x: F.struct(x["feature"].alias("feature"), (x["value"] + 3e-6).alias("value")))
        return explain(*args).withColumn("contributions", moved)

    monkeypatch.setattr(K, "score", worse_on_new_weeks)
    monkeypatch.setattr(K, "with_shapley_contributions", nearly)
    got = K.scored_snapshot(K.Tables(spark, "/root/testdata/sf0.001")).select("beats_mean", "adds_up").distinct().collect()
    assert got == [(False, False)]
