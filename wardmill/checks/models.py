"""Metrics, preprocessing, attribution, gate and model runs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.checks import views as V
from wardmill.checks.panels import _feature_sql, features
from wardmill.checks.registry import Tables, check
from wardmill.checks.views import oracle
from wardmill.checks.views import rounded as _rounded
from wardmill.operators import metrics as M
from wardmill.operators import prep as P
from wardmill.functions.measures import high_strain
from wardmill.operators.aggregates import class_weights, with_class_weight
from wardmill.operators.attribution import contribution_array, linear_contributions, top_contributions
from wardmill.operators.dedup import latest_snapshot, pick_champion
from wardmill.operators.linear import fit_logistic, fit_ridge
from wardmill.operators.ordered import exact_medians
from wardmill.operators.panel import temporal_split
from wardmill.operators.shape import conform
from wardmill.plans.explain import TreeArrays, expected_value, explained_column, shapley_values, tree_arrays, with_shapley_contributions
from wardmill.plans.features import LABEL, TARGET
from wardmill.plans.models import BoostingParams, score, train_model
from wardmill.schemas import PREDICTION_RAW
from wardmill.session import ensure_checkpoint_dir

c = F.col


REGRESSION_SQL = """
SELECT model_name, COUNT(*) AS n_test_rows, AVG(abs(p - y)) AS mae, sqrt(AVG((p - y) * (p - y))) AS rmse,
  1 - SUM((p - y) * (p - y)) / NULLIF(var_pop(y) * COUNT(y), 0) AS r2,
  AVG(abs(p - y) / greatest(y, CAST(0.01 AS DOUBLE))) * 100 AS mape, AVG(p - y) AS pred_bias
FROM v_scores GROUP BY 1
"""

BINARY_SQL = """
SELECT model_name, COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS precision,
  COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS recall,
  COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0), 0) AS f1
FROM (SELECT model_name, COUNT(*) FILTER (prob >= 0.5 AND label = 1) AS tp,
    COUNT(*) FILTER (prob >= 0.5 AND label = 0) AS fp, COUNT(*) FILTER (prob < 0.5 AND label = 1) AS fn
  FROM v_scores GROUP BY 1) g
"""

AUC_SQL = """
SELECT model_name, (SUM(CASE WHEN label = 1 THEN mean_rank ELSE 0 END)
    - COUNT(*) FILTER (label = 1) * (COUNT(*) FILTER (label = 1) + 1) / CAST(2 AS DOUBLE))
  / NULLIF(CAST(COUNT(*) FILTER (label = 1) AS DOUBLE) * COUNT(*) FILTER (label = 0), 0) AS roc_auc
FROM (SELECT model_name, label, rank() OVER (PARTITION BY model_name ORDER BY prob)
    + (COUNT(*) OVER (PARTITION BY model_name, prob) - 1) / CAST(2 AS DOUBLE) AS mean_rank FROM v_scores) r
GROUP BY 1
"""

ALERT_SQL = """
SELECT model_name, CAST(COUNT(*) FILTER (p >= CAST(0.9 AS DOUBLE)) AS DOUBLE) / COUNT(*) AS alert_rate
FROM v_scores GROUP BY 1
"""

EVALUATION_SQL = f"""
SELECT r.*, precision, recall, f1, alert_rate, roc_auc FROM ({REGRESSION_SQL}) r JOIN ({BINARY_SQL}) b USING (model_name)
JOIN ({AUC_SQL}) a USING (model_name) JOIN ({ALERT_SQL}) al USING (model_name)
"""


def _round_sql(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


@check("A13 X04", oracle(f"""
SELECT model_name, n_test_rows, {_round_sql("mae", "rmse", "r2", "mape", "pred_bias")} FROM ({REGRESSION_SQL}) r
""", "v_scores"))
def regression_quality(t: Tables) -> DataFrame:
    return _rounded(M.regression_metrics(V.scores(t), "y", "p", ["model_name"]))


@check("A14", oracle(f"""
SELECT model_name, {_round_sql("precision", "recall", "f1")} FROM ({BINARY_SQL}) b
""", "v_scores"))
def binary_quality(t: Tables) -> DataFrame:
    return _rounded(M.binary_metrics(V.scores(t), "label", "prob", ["model_name"]))


@check("A15", oracle(f"SELECT model_name, round(roc_auc, 6) AS roc_auc FROM ({AUC_SQL}) a", "v_scores"))
def area_under_curve(t: Tables) -> DataFrame:
    return _rounded(M.roc_auc(V.scores(t), "label", "prob", ["model_name"]))


@check("A15", """
SELECT round((SUM(CASE WHEN late THEN mean_rank ELSE 0 END)
    - COUNT(*) FILTER (late) * (COUNT(*) FILTER (late) + 1) / CAST(2 AS DOUBLE))
  / (CAST(COUNT(*) FILTER (late) AS DOUBLE) * COUNT(*) FILTER (NOT late)), 6) AS roc_auc
FROM (SELECT l_returnflag = 'R' AS late, rank() OVER (ORDER BY l_extendedprice)
    + (COUNT(*) OVER (PARTITION BY l_extendedprice) - 1) / CAST(2 AS DOUBLE) AS mean_rank FROM lineitem) r
""")
def area_under_curve_overall(t: Tables) -> DataFrame:
    rows = t.lineitem.select((c("l_returnflag") == "R").cast("int").alias("label"), "l_extendedprice")
    return _rounded(M.roc_auc(rows, "label", "l_extendedprice"))


@check("A16 A07", oracle("""
SELECT model_name, COUNT(*) AS n_rows, round(AVG(pred_occupancy_next_week), 6) AS mean_predicted,
  round(AVG(actual_occupancy), 6) AS mean_actual,
  COUNT(*) FILTER (pred_occupancy_next_week >= CAST(0.9 AS DOUBLE)) AS n_alerts,
  round(CAST(COUNT(*) FILTER (pred_occupancy_next_week >= CAST(0.9 AS DOUBLE)) AS DOUBLE) / COUNT(*), 6) AS alert_rate,
  round(AVG(pred_high_strain), 6) AS strain_rate, round(AVG(abs(actual_occupancy - pred_occupancy_next_week)), 6) AS mae
FROM v_predictions GROUP BY 1
""", "v_predictions"))
def prediction_distribution(t: Tables) -> DataFrame:
    return _rounded(M.prediction_summary(
        V.predictions(t), "pred_occupancy_next_week", "actual_occupancy", "pred_high_strain"
    ))


@check("A17", """
SELECT toxic, n_class, round(CAST(n AS DOUBLE) / (k * n_class), 6) AS balanced_weight,
  round(CAST(neg AS DOUBLE) / greatest(pos, 1), 6) AS scale_pos_weight
FROM (SELECT toxic, COUNT(*) AS n_class FROM labels GROUP BY 1) g,
  (SELECT COUNT(*) AS n, COUNT(DISTINCT toxic) AS k, COUNT(*) FILTER (toxic = 0) AS neg,
    COUNT(*) FILTER (toxic = 1) AS pos FROM labels) s
""")
def label_weights(t: Tables) -> DataFrame:
    return _rounded(class_weights(t.labels, "toxic"))


@check("A18", """
SELECT l_returnflag, l_linestatus, median(l_extendedprice) AS median FROM lineitem GROUP BY 1, 2
""")
def grouped_medians(t: Tables) -> DataFrame:
    return exact_medians(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice")


TRAIN = "c_nationkey < 15"
BALANCE = "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END"
SEGMENT = "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment || '-' || CAST(c_nationkey % 20 AS VARCHAR) END"
CUSTOMERS_SQL = f"""
SELECT c_custkey, {BALANCE} AS balance, CAST(c_nationkey AS DOUBLE) AS nation, {SEGMENT} AS segment, {TRAIN} AS train
FROM customer
"""


def _customers(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        F.when(c("c_mktsegment") != "BUILDING", c("c_acctbal")).alias("balance"),
        c("c_nationkey").cast("double").alias("nation"),
        F.when(c("c_acctbal") >= 0, F.concat("c_mktsegment", F.lit("-"), (c("c_nationkey") % 20).cast("string")))
        .alias("segment"),
        (c("c_nationkey") < 15).alias("train"),
    )


STATS_SQL = f"""
WITH cust AS ({CUSTOMERS_SQL}), med AS (SELECT median(balance) AS b, median(nation) AS n FROM cust WHERE train)
SELECT 'balance' AS feature, (SELECT b FROM med) AS median, AVG(COALESCE(balance, (SELECT b FROM med))) AS mean,
  stddev_pop(COALESCE(balance, (SELECT b FROM med))) AS deviation FROM cust WHERE train
UNION ALL
SELECT 'nation', (SELECT n FROM med), AVG(nation), stddev_pop(nation) FROM cust WHERE train
"""


@check("A18 A19", f"""
SELECT feature, {_round_sql("median", "mean", "deviation")} FROM ({STATS_SQL}) s
""")
def imputation_statistics(t: Tables) -> DataFrame:
    return _rounded(P.numeric_stats(_customers(t).filter("train"), ["balance", "nation"]))


@check("A18", f"""
WITH cust AS ({CUSTOMERS_SQL})
SELECT 'segment' AS feature, segment AS mode FROM (SELECT segment, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, segment) AS rn
  FROM cust WHERE train AND segment IS NOT NULL GROUP BY 1) g WHERE rn = 1
""")
def frequent_categories(t: Tables) -> DataFrame:
    return P.modes(_customers(t).filter("train"), ["segment"])


@check("M01 A18 A19", f"""
WITH cust AS ({CUSTOMERS_SQL}), stats AS ({STATS_SQL}),
codes AS (SELECT segment, ROW_NUMBER() OVER (ORDER BY segment) - 1 AS code FROM (
  SELECT DISTINCT segment FROM cust WHERE train AND segment IS NOT NULL) d),
mode AS (SELECT segment FROM (SELECT segment, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, segment) AS rn
  FROM cust WHERE train AND segment IS NOT NULL GROUP BY 1) g WHERE rn = 1)
SELECT c_custkey, round((COALESCE(balance, b.median) - b.mean) / b.deviation, 6) AS balance,
  round((nation - n.mean) / n.deviation, 6) AS nation, CAST(COALESCE(code, -1) AS DOUBLE) AS segment, train
FROM cust CROSS JOIN (SELECT * FROM stats WHERE feature = 'balance') b
CROSS JOIN (SELECT * FROM stats WHERE feature = 'nation') n CROSS JOIN mode
LEFT JOIN codes ON COALESCE(cust.segment, mode.segment) = codes.segment
""")
def preprocessed_rows(t: Tables) -> DataFrame:
    rows = _customers(t)
    prep = P.fit_preprocessor(rows.filter("train"), ["balance", "nation"], ["segment"])
    return _rounded(prep.apply(rows))


@check("S04 X19 X20", """
WITH base AS (SELECT ROW_NUMBER() OVER () AS rid, l_orderkey, l_linenumber, l_quantity - 25 AS q, l_discount * 100 - 5 AS d,
  l_tax * 100 - 4 AS x, CAST(l_linenumber - 4 AS DOUBLE) AS n FROM lineitem),
long AS (SELECT rid, l_orderkey, l_linenumber, 0 AS pos, 'quantity' AS f, q AS v FROM base
  UNION ALL SELECT rid, l_orderkey, l_linenumber, 1, 'discount', d FROM base
  UNION ALL SELECT rid, l_orderkey, l_linenumber, 2, 'tax', x FROM base
  UNION ALL SELECT rid, l_orderkey, l_linenumber, 3, 'line', n FROM base),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY rid ORDER BY abs(v) DESC, pos DESC) AS k FROM long)
SELECT l_orderkey, l_linenumber, MAX(f) FILTER (k = 1) AS top1_feature, MAX(round(v, 4)) FILTER (k = 1) AS top1_shap,
  MAX(CASE WHEN v > 0 THEN 'up' ELSE 'down' END) FILTER (k = 1) AS top1_direction,
  MAX(f) FILTER (k = 2) AS top2_feature, MAX(round(v, 4)) FILTER (k = 2) AS top2_shap,
  MAX(CASE WHEN v > 0 THEN 'up' ELSE 'down' END) FILTER (k = 2) AS top2_direction,
  MAX(f) FILTER (k = 3) AS top3_feature, MAX(round(v, 4)) FILTER (k = 3) AS top3_shap,
  MAX(CASE WHEN v > 0 THEN 'up' ELSE 'down' END) FILTER (k = 3) AS top3_direction,
  string_agg(printf('%s (%s %.3f)', f, CASE WHEN v > 0 THEN 'up' ELSE 'down' END, abs(v)), ', ' ORDER BY k)
    FILTER (k <= 3) AS explanation
FROM ranked GROUP BY rid, l_orderkey, l_linenumber
""")
def strongest_contributions(t: Tables) -> DataFrame:
    parts = {
        "quantity": c("l_quantity") - 25, "discount": c("l_discount") * 100 - 5, "tax": c("l_tax") * 100 - 4,
        "line": c("l_linenumber") - 4,
    }
    rows = t.lineitem.select("l_orderkey", "l_linenumber", contribution_array(parts).alias("contributions"))
    return top_contributions(rows).drop("contributions")


@check("M06", """
SELECT l_orderkey, l_linenumber, l_partkey, round(kq * (l_quantity - mq), 4) AS from_quantity,
  round(kd * (l_discount - md), 4) AS from_discount, round(my - kq * mq - kd * md + kq * mq + kd * md, 4) AS base_value
FROM lineitem, (SELECT covar_pop(l_extendedprice, l_quantity) / var_pop(l_quantity) AS kq, AVG(l_quantity) AS mq,
  covar_pop(l_extendedprice, l_discount) / var_pop(l_discount) AS kd, AVG(l_discount) AS md,
  AVG(l_extendedprice) AS my FROM lineitem) s
""")
def linear_attribution(t: Tables) -> DataFrame:
    fit = t.lineitem.agg(F.struct(
        (F.covar_pop("l_extendedprice", "l_quantity") / F.var_pop("l_quantity")).alias("kq"),
        F.avg("l_quantity").alias("mq"),
        (F.covar_pop("l_extendedprice", "l_discount") / F.var_pop("l_discount")).alias("kd"),
        F.avg("l_discount").alias("md"),
        F.avg("l_extendedprice").alias("my"),
    ).alias("s"))
    rows = t.lineitem.withColumn("_s", fit.scalar())
    intercept = c("_s.my") - c("_s.kq") * c("_s.mq") - c("_s.kd") * c("_s.md")
    explained = linear_contributions(
        rows, {"l_quantity": c("_s.kq"), "l_discount": c("_s.kd")},
        {"l_quantity": c("_s.mq"), "l_discount": c("_s.md")}, intercept,
    )
    return explained.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(c("contributions")[0]["value"], 4).alias("from_quantity"),
        F.round(c("contributions")[1]["value"], 4).alias("from_discount"),
        F.round("shap_base_value", 4).alias("base_value"),
    )


# --- exact learners, tree attribution ---------------------------------------------------------

PENALTY = 0.0001
_DET = """({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"""


def _solved_sql(matrix: list[str], right: list[str]) -> list[str]:
    """The three unknowns of a system of three equations, as quotients of determinants."""
    det = lambda cells: _DET.format(**dict(zip("abcdefghi", cells, strict=True)))
    out = []
    for j in range(3):
        cells = [right[i // 3] if i % 3 == j else x for i, x in enumerate(matrix)]
        out.append(f"{det(cells)} / {det(matrix)}")
    return out


_COVARIANCES = f"""
SELECT var_pop(l_quantity) + {PENALTY} AS qq, var_pop(l_discount) + {PENALTY} AS dd, var_pop(l_tax) + {PENALTY} AS tt,
  covar_pop(l_quantity, l_discount) AS qd, covar_pop(l_quantity, l_tax) AS qt, covar_pop(l_discount, l_tax) AS dt,
  covar_pop(l_quantity, l_extendedprice) AS qy, covar_pop(l_discount, l_extendedprice) AS dy, covar_pop(l_tax, l_extendedprice) AS ty,
  AVG(l_quantity) AS mq, AVG(l_discount) AS md, AVG(l_tax) AS mt, AVG(l_extendedprice) AS my FROM lineitem
"""
_RIDGE = "SELECT *, my - kq * mq - kd * md - kt * mt AS k0 FROM (SELECT *, {} AS kq, {} AS kd, {} AS kt FROM ({}) m) s".format(
    *_solved_sql(["qq", "qd", "qt", "qd", "dd", "dt", "qt", "dt", "tt"], ["qy", "dy", "ty"]), _COVARIANCES)
LINEAR = ["l_quantity", "l_discount", "l_tax"]


@check("M03", f"""
SELECT term, round(coefficient, 3) AS coefficient FROM (SELECT unnest(['intercept', 'l_quantity', 'l_discount', 'l_tax']) AS term,
  unnest([k0, kq, kd, kt]) AS coefficient FROM ({_RIDGE}) r) u
""")
def ridge_coefficients(t: Tables) -> DataFrame:
    return _rounded(fit_ridge(t.lineitem, LINEAR, "l_extendedprice", PENALTY).terms(t.lineitem), 3)


@check("M03 M05", f"""
SELECT l_orderkey, l_linenumber, l_partkey, round(k0 + kq * l_quantity + kd * l_discount + kt * l_tax, 1) AS score
FROM lineitem CROSS JOIN ({_RIDGE}) r
""")
def ridge_scores(t: Tables) -> DataFrame:
    model = fit_ridge(t.lineitem, LINEAR, "l_extendedprice", PENALTY)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(model.score(), 1).alias("score"))


def _logistic_sql() -> str:
    h = ["h00", "h01", "h02", "h01", "h11", "h12", "h02", "h12", "h22"]
    steps = _solved_sql(h, ["g0", "g1", "g2"])
    return f"""
WITH RECURSIVE x AS (SELECT l_quantity / 50 AS a, l_tax * 10 AS b, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
    CAST(COUNT(*) OVER () AS DOUBLE) / (2 * COUNT(*) OVER (PARTITION BY l_returnflag = 'R')) AS w FROM lineitem),
it AS (SELECT 0 AS i, CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS b2
  UNION ALL SELECT i + 1, b0 + {steps[0]}, b1 + {steps[1]}, b2 + {steps[2]}
  FROM (SELECT i, b0, b1, b2, SUM(w * p * (1 - p)) AS h00, SUM(w * p * (1 - p) * a) AS h01, SUM(w * p * (1 - p) * b) AS h02,
      SUM(w * p * (1 - p) * a * a) + 0.01 * SUM(w) AS h11, SUM(w * p * (1 - p) * a * b) AS h12, SUM(w * p * (1 - p) * b * b) + 0.01 * SUM(w) AS h22,
      SUM(w * (y - p)) AS g0, SUM(w * (y - p) * a) - 0.01 * SUM(w) * b1 AS g1, SUM(w * (y - p) * b) - 0.01 * SUM(w) * b2 AS g2
    FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * a + b2 * b))) AS p FROM it, x WHERE i < 12) q GROUP BY i, b0, b1, b2) s)
SELECT term, round(coefficient, 6) AS coefficient FROM (SELECT unnest(['intercept', 'a', 'b']) AS term, unnest([b0, b1, b2]) AS coefficient
  FROM it WHERE i = 12) u
"""


@check("M04 A17", _logistic_sql())
def logistic_coefficients(t: Tables) -> DataFrame:
    """Balanced classes, found by iterated reweighting; the statement takes twelve Newton steps."""
    rows = t.lineitem.select((c("l_quantity") / 50).alias("a"), (c("l_tax") * 10).alias("b"), (c("l_returnflag") == "R").cast("int").alias("y"))
    weighted = with_class_weight(rows, "y")
    return _rounded(fit_logistic(weighted, ["a", "b"], "y", 0.01, "class_weight").terms(rows))


#: A small fixed tree over quantity, discount and tax: quantity is asked twice on the right side.
_LEAVES = {"a": "l_quantity <= 25 AND l_discount <= 0.05", "b": "l_quantity <= 25 AND l_discount > 0.05",
           "c": "l_quantity > 25 AND l_quantity <= 40 AND l_tax <= 0.04", "d": "l_quantity > 25 AND l_quantity <= 40 AND l_tax > 0.04",
           "e": "l_quantity > 40"}


def _subset_value(quantity: bool, discount: bool, tax: bool) -> str:
    """Expected value of the tree where only the given features are known."""
    left = "CASE WHEN l_discount <= 0.05 THEN va ELSE vb END" if discount else "(na * va + nb * vb) / (na + nb)"
    inner = "CASE WHEN l_tax <= 0.04 THEN vc ELSE vd END" if tax else "(nc * vc + nd * vd) / (nc + nd)"
    right = f"CASE WHEN l_quantity <= 40 THEN {inner} ELSE ve END" if quantity else f"((nc + nd) * ({inner}) + ne * ve) / (nc + nd + ne)"
    return f"CASE WHEN l_quantity <= 25 THEN {left} ELSE {right} END" if quantity else (
        f"((na + nb) * ({left}) + (nc + nd + ne) * ({right})) / (na + nb + nc + nd + ne)")


def _shapley_sql(feature: int) -> str:
    others = [i for i in range(3) if i != feature]
    parts = []
    for one in (False, True):
        for two in (False, True):
            known = {others[0]: one, others[1]: two}
            with_, without = (_subset_value(*[(known | {feature: v})[i] for i in range(3)]) for v in (True, False))
            parts.append(f"({with_} - ({without})) / {6 if one != two else 3}")
    return " + ".join(parts)


@check("M06", f"""
WITH l AS (SELECT {", ".join(f"CAST(COUNT(*) FILTER ({w}) AS DOUBLE) AS n{k}, AVG(l_extendedprice) FILTER ({w}) AS v{k}" for k, w in _LEAVES.items())} FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round({_shapley_sql(0)}, 2) AS of_quantity, round({_shapley_sql(1)}, 2) AS of_discount,
  round({_shapley_sql(2)}, 2) AS of_tax, round({_subset_value(False, False, False)}, 2) AS base_value FROM lineitem CROSS JOIN l
""")
def tree_shapley(t: Tables) -> DataFrame:
    """Leaf values and covers are means and counts of the table."""
    row = t.lineitem.agg(*[F.count_if(F.expr(w)).alias(f"n{k}") for k, w in _LEAVES.items()],
                         *[F.avg(F.when(F.expr(w), c("l_extendedprice"))).alias(f"v{k}") for k, w in _LEAVES.items()]).first()
    n, v = ({k: float(row[f"{x}{k}"] or 0) for k in _LEAVES} for x in "nv")
    right = n["c"] + n["d"] + n["e"]
    # node: 0 quantity 25, 1 discount 0.05, 2 a, 3 b, 4 quantity 40, 5 tax 0.04, 6 c, 7 d, 8 e
    tree = TreeArrays(
        np.array([0, 1, -1, -1, 0, 2, -1, -1, -1]), np.array([25, 0.05, 0, 0, 40, 0.04, 0, 0, 0]), np.array([1, 2, -1, -1, 5, 6, -1, -1, -1]),
        np.array([4, 3, -1, -1, 8, 7, -1, -1, -1]), np.array([0, 0, v["a"], v["b"], 0, 0, v["c"], v["d"], v["e"]]), 1.0,
        np.array([n["a"] + n["b"] + right, n["a"] + n["b"], n["a"], n["b"], right, n["c"] + n["d"], n["c"], n["d"], n["e"]]))
    shares = explained_column(F.array(*[c(x).cast("double") for x in LINEAR]), [tree], shapley_values)
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", shares.alias("s"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", *[F.round(c("s")[i], 2).alias(f"of_{x}") for i, x in enumerate(("quantity", "discount", "tax"))],
                       F.round(F.lit(expected_value([tree])), 2).alias("base_value"))


# --- evaluation, gate, registry --------------------------------------------------------------


def _evaluated(t: Tables) -> DataFrame:
    return M.evaluate(V.scores(t), "y", "p", "label", "prob")


def _registry(t: Tables) -> DataFrame:
    return t.documents.select(
        c("lang").alias("model_name"),
        F.when(c("n_chars") > 1000, "production").otherwise("candidate").alias("status"),
        c("doc_id").alias("create_time"),
        ((c("n_chars") % 1000) / 1000).alias("test_mae"),
    )


INCUMBENT_SQL = """
SELECT lang AS model_name, CAST(n_chars % 1000 AS DOUBLE) / 1000 AS incumbent_mae FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY doc_id DESC) AS rn FROM documents WHERE n_chars > 1000) r
WHERE rn = 1
"""


@check("M07 A13 A14 A15 A16", oracle(f"""
SELECT model_name, n_test_rows, {_round_sql("mae", "rmse", "r2", "mape", "pred_bias", "precision", "recall", "f1",
                                            "alert_rate", "roc_auc")} FROM ({EVALUATION_SQL}) e
""", "v_scores"))
def evaluation(t: Tables) -> DataFrame:
    return _rounded(_evaluated(t))


@check("M11 W01", f"SELECT model_name, round(incumbent_mae, 6) AS incumbent_mae FROM ({INCUMBENT_SQL}) i")
def incumbents(t: Tables) -> DataFrame:
    return _rounded(M.incumbent(_registry(t)))


@check("M08", oracle(f"""
SELECT model_name, concat_ws(',', CASE WHEN mae >= 0.1 THEN 'mae' END, CASE WHEN r2 <= 0.75 THEN 'r2' END,
    CASE WHEN roc_auc <= 0.85 THEN 'roc_auc' END, CASE WHEN mae > incumbent_mae + 0.005 THEN 'incumbent' END) AS failures,
  NOT (mae >= 0.1 OR COALESCE(r2 <= 0.75, FALSE) OR COALESCE(roc_auc <= 0.85, FALSE)
    OR COALESCE(mae > incumbent_mae + 0.005, FALSE)) AS gate_passed
FROM ({EVALUATION_SQL}) e LEFT JOIN ({INCUMBENT_SQL}) i USING (model_name)
""", "v_scores"))
def gated_models(t: Tables) -> DataFrame:
    gated = M.gate_models(_evaluated(t), M.incumbent(_registry(t)))
    return gated.select("model_name", F.array_join("gate_failures", ",").alias("failures"), "gate_passed")


@check("M09 S06", oracle(f"""
SELECT model_name, round(mae, 6) AS mae, CASE WHEN ROW_NUMBER() OVER (ORDER BY mae, CASE WHEN model_name = 'en' THEN 0
  ELSE 1 END, model_name) = 1 THEN 'production' ELSE 'candidate' END AS status
FROM ({REGRESSION_SQL}) r
""", "v_scores"))
def champion_status(t: Tables) -> DataFrame:
    metrics = M.regression_metrics(V.scores(t), "y", "p", ["model_name"])
    return _rounded(pick_champion(metrics, "en").select("model_name", "mae", "status"))


@check("M12", oracle(f"""
SELECT model_name, '20221231' AS train_end_date, CAST(floor(mae * 1000) AS BIGINT) AS test_mae_millimae,
  CAST(trunc(greatest(0, r2 * 100)) AS BIGINT) AS test_r2_centesimal,
  COALESCE(CAST(trunc(roc_auc * 100) AS BIGINT), 0) AS test_auc_centesimal, n_test_rows AS test_rows
FROM ({EVALUATION_SQL}) e
""", "v_scores"))
def registry_rows(t: Tables) -> DataFrame:
    return M.registry_labels(_evaluated(t), "2022-12-31")


@check("M10", oracle(f"""
SELECT e.model_name, '2001-06-30' AS evaluation_timestamp, g.gate_passed, g.failures,
  CASE WHEN NOT g.gate_passed THEN NULL WHEN e.model_name = (SELECT model_name FROM ({EVALUATION_SQL}) x
      JOIN gates USING (model_name) WHERE gate_passed ORDER BY mae, model_name <> 'en', model_name LIMIT 1)
    THEN 'production' ELSE 'candidate' END AS registered_status,
  '2022-12-31' AS train_end, '2023-09-30' AS val_end, n_test_rows,
  {_round_sql("mae", "rmse", "r2", "mape", "pred_bias", "precision", "recall", "f1", "roc_auc", "alert_rate")}
FROM ({EVALUATION_SQL}) e JOIN gates g ON e.model_name = g.model_name
""".replace("SELECT e.model_name, '2001", f"""WITH gates AS (SELECT model_name,
  concat_ws(',', CASE WHEN mae >= 0.1 THEN 'mae' END, CASE WHEN r2 <= 0.75 THEN 'r2' END,
    CASE WHEN roc_auc <= 0.85 THEN 'roc_auc' END, CASE WHEN mae > incumbent_mae + 0.005 THEN 'incumbent' END) AS failures,
  NOT (mae >= 0.1 OR COALESCE(r2 <= 0.75, FALSE) OR COALESCE(roc_auc <= 0.85, FALSE)
    OR COALESCE(mae > incumbent_mae + 0.005, FALSE)) AS gate_passed
FROM ({EVALUATION_SQL}) e LEFT JOIN ({INCUMBENT_SQL}) i USING (model_name))
SELECT e.model_name, '2001"""), "v_scores"))
def evaluation_reports(t: Tables) -> DataFrame:
    gated = M.gate_models(_evaluated(t), M.incumbent(_registry(t)))
    champion = pick_champion(gated.filter("gate_passed"), "en")
    report = M.evaluation_report(gated, champion, V.AS_OF, "2022-12-31", "2023-09-30")
    return _rounded(report.select(
        "model_name", "evaluation_timestamp", "gate_passed", F.array_join("gate_failures", ",").alias("failures"),
        "registered_status", "train_summary.*", "test_metrics.*",
    ))


# --- model runs: checked by row count and by unit tests ------------------------------------------

QUICK = BoostingParams(maxIter=4, maxDepth=3, stepSize=0.3, maxBins=32)
NUMERIC = ["inpatient_capacity", "icu_occupancy_rate", "occ_lag1", "occ_lag4", "occ_roll4", "occ_roll8", "covid_patients",
           "flu_roll4", "occ_wow_pct_change", "week_number", "certified_bed_count", "population_density"]
CATEGORICAL = ["season", "hospital_type", "hrr_region"]


def _known_target() -> Column:
    """A function of features, so that a trained model has something to find at every scale."""
    season = F.when(c("season") == "Winter", 0.1).otherwise(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.1 + 0.5 * c("occ_lag1") + 0.2 * c("occ_roll4") + season))


@check("M03 M04 M05 M06 S04 SK17 W05", oracle(f"""
SELECT hospital_id, MAX(report_date) AS report_date, TRUE AS in_range, TRUE AS adds_up, TRUE AS label_agrees, TRUE AS beats_mean
FROM ({_feature_sql()}) f WHERE report_date >= (SELECT MAX(report_date) FROM ({_feature_sql()}) g) - 365 GROUP BY 1
""", "v_fact", "v_calendar", "v_hospitals", "v_population", "v_geography"))
def scored_snapshot(t: Tables) -> DataFrame:
    """Train on the early weeks of the whole feature store, explain and score each facility's newest snapshot.

    What a statement can say of a model's output: the keys, predictions and probabilities inside [0, 1], base value and
    contributions that add up to the prediction, labels that follow the probability, and at most two thirds of the error over the
    snapshots that the mean of the training rows has. The target is a known function of features; next week's real rate is
    noise in these tables. The sum is judged with the base value before it is rounded for storage.
    """
    ensure_checkpoint_dir(t.spark)
    known = features(t).withColumn(TARGET, _known_target()).withColumn(LABEL, high_strain(c(TARGET)))
    rows = known.select("hospital_id", "report_date", *NUMERIC, *CATEGORICAL, TARGET, LABEL).checkpoint()
    split = temporal_split(rows, "report_date", "2000-06-30", "2001-03-31")
    model = train_model(
        split, "XGBoost", QUICK, numeric=NUMERIC, categorical=CATEGORICAL, version="XGBoost@check"
    )
    newest = str(rows.agg(F.max("report_date")).first()[0])
    scored = with_shapley_contributions(
        score(model, latest_snapshot(rows, "hospital_id", "report_date", newest, 365), newest), model.regressor, model.features)
    total = F.aggregate("contributions", F.lit(0.0), lambda s, x: s + x["value"])
    batch = conform(top_contributions(scored).withColumn("total", total), f"{PREDICTION_RAW}, raw_prediction double, total double")
    mean = split.filter("split = 'train'").agg(F.avg(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c(TARGET))))).scalar()
    errors = batch.agg((F.avg("abs_error") < F.avg(F.abs(c("actual_occupancy") - mean)) * 2 / 3).alias("better"))
    base = expected_value(tree_arrays(model.regressor))
    raw = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(base) + c("total")))
    return batch.select(
        "hospital_id", "report_date",
        (c("pred_occupancy_next_week").between(0, 1) & c("pred_high_strain_prob").between(0, 1)).alias("in_range"),
        ((F.abs(raw - c("raw_prediction")) < 1e-6) & (F.abs(c("shap_base_value") - base) <= 5.1e-5)).alias("adds_up"),
        (((c("pred_high_strain") == 1) == (c("pred_high_strain_prob") > 0.5)) | (c("pred_high_strain_prob") == 0.5)).alias("label_agrees"),
        errors.scalar().alias("beats_mean"),
    )
