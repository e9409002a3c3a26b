"""Row rules, gates, assertions and one-row checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from wardmill import constants as K
from wardmill.functions.measures import flag, safe_div


@dataclass(frozen=True)
class Rule:
    code: str
    needs: tuple[str, ...]
    violated: Column


def utilization_rules(as_of: str) -> list[Rule]:
    """In reporting order: the first code of a row is the one a single-code report shows."""
    c = F.col
    return [
        Rule(K.RULE_FUTURE_DATE, ("report_date",), c("report_date") > F.lit(as_of).cast("date")),
        Rule(K.RULE_OVER_120, ("occupancy_rate",), c("occupancy_rate") > 120),
        Rule(K.RULE_ICU_USED, ("icu_beds_used", "icu_beds_staffed"), c("icu_beds_used") > c("icu_beds_staffed")),
        Rule(K.RULE_ICU_TOTAL, ("icu_beds_staffed", "inpatient_beds_total"),
             c("icu_beds_staffed") > c("inpatient_beds_total")),
        Rule(K.RULE_ZERO_BEDS, ("inpatient_beds_total", "inpatient_beds_used"),
             (c("inpatient_beds_total") == 0) & (c("inpatient_beds_used") > 0)),
        Rule(K.RULE_COVID_TOTAL, ("covid_patients", "total_patients"), c("covid_patients") > c("total_patients")),
        Rule(K.RULE_NO_KEY, ("provider_id", "report_date"), c("provider_id").isNull() | c("report_date").isNull()),
    ]


def facility_rules(as_of: str) -> list[Rule]:
    missing = Rule(K.RULE_NO_KEY, ("provider_id",), F.col("provider_id").isNull())
    return [*utilization_rules(as_of)[:1], missing]


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``_violations`` (every broken rule, in order) and ``_has_violation``.

    A rule whose columns are absent is skipped; a comparison with NULL breaks no rule.
    """
    hits = [F.when(r.violated, F.lit(r.code)) for r in rules if set(r.needs) <= set(df.columns)]
    broken = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    return df.withColumn("_violations", broken).withColumn("_has_violation", F.size("_violations") > 0)


def first_violation(c: Column) -> Column:
    """The single code that a first-hit-only report stores."""
    return F.try_element_at(c, F.lit(1))


def gate(df: DataFrame, condition: Column, reason: str) -> DataFrame:
    """Adds ``_has_violation`` and ``error_reason``; a NULL condition is a violation."""
    bad = ~F.coalesce(condition, F.lit(False))
    return df.withColumns({"_has_violation": bad, "error_reason": F.when(bad, F.lit(reason))})


def geography_gate(df: DataFrame) -> DataFrame:
    c = F.col
    condition = c("county_fips").rlike(r"^\d{5}$") & c("state_code").isNotNull()
    return gate(df, condition, K.GEOGRAPHY_GATE_REASON)


def population_gate(df: DataFrame) -> DataFrame:
    c = F.col
    condition = c("county_fips").rlike(r"^\d{5}$") & c("census_year").isNotNull() & (c("total_population") >= 0)
    return gate(df, condition, K.POPULATION_GATE_REASON)


def quarantine_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    bad = F.count_if("_has_violation")
    total = F.count(F.lit(1))
    return df.groupBy(*by).agg(
        total.alias("total_rows"),
        (total - bad).alias("clean_rows"),
        bad.alias("quarantine_rows"),
        safe_div(bad, total).alias("quarantine_rate"),
    )


def assert_rule(df: DataFrame, broken: Column) -> DataFrame:
    """Rows that break a rule; an empty result passes."""
    return df.filter(broken)


def utilization_assertion(rate: Column, capacity: Column, used: Column) -> Column:
    return (rate > 1.5) | (capacity < 0) | (used < 0) | ((used > capacity) & (rate <= 1.0))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def assert_not_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    broken = F.lit(False)
    for n in names:
        broken = broken | F.col(n).isNull()
    return df.filter(broken)


def null_rates(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Long table (column, null rate) from one pass."""
    rates = df.agg(*[F.avg(F.col(n).isNull().cast("double")).alias(n) for n in names])
    return rates.unpivot([], list(names), "column_name", "null_rate")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat an earlier key (NULL keys compare equal)."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def validate_panel(
    df: DataFrame, keys: Sequence[str], targets: Sequence[str],
    max_null_target: float = K.MAX_NULL_TARGET_RATE,
) -> DataFrame:
    """One report row: row count, null rates, duplicates and an overall verdict.

    Rows are first folded to one per key with sums of the null flags, so the
    duplicate count and the rates come out of the same pass.
    """
    present = [t for t in targets if t in df.columns]
    nulls = {f"null_{n}": n for n in (*keys, *present)}
    groups = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(n).isNull()).alias(a) for a, n in nulls.items()],
    )
    report = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
        *[safe_div(F.sum(a), F.sum("_n")).alias(a.replace("null_", "null_rate_", 1)) for a in nulls],
    )
    verdict = F.col("n_rows") > 0
    for n in keys:
        verdict = verdict & (F.col(f"null_rate_{n}") == 0)
    for n in present:
        verdict = verdict & (F.col(f"null_rate_{n}") <= max_null_target)
    return report.withColumn("panel_ok", F.coalesce(verdict, F.lit(False)))


def check_predictions(df: DataFrame, run_date: str, primary: str = K.PRIMARY_MODEL) -> DataFrame:
    rows = df.filter(F.col("run_date") == F.lit(run_date).cast("date"))
    return rows.agg(
        flag(F.count(F.lit(1)) >= 1).alias("has_rows"),
        flag(F.count_if(F.col("model_name") == primary) > 0).alias("has_primary_model"),
        flag(F.count_if(F.col("pred_occupancy_next_week").isNull()) == 0).alias("no_null_predictions"),
        flag(F.count_if(F.col("top1_feature").isNull()) == 0).alias("no_null_attribution"),
    )


def check_forecast(
    df: DataFrame, run_date: str, max_unmatched: float = K.MAX_UNMATCHED_NAME_RATE
) -> DataFrame:
    rows = df.filter(F.col("run_date") == F.lit(run_date).cast("date"))
    unmatched = safe_div(F.count_if(F.col("hospital_name").isNull()), F.count(F.lit(1)))
    return rows.agg(
        flag(F.count(F.lit(1)) >= 1).alias("has_rows"),
        flag(F.count_if(F.col("alert_flag").isNull()) == 0).alias("no_null_alert"),
        flag(F.count_if(F.col("shap_feature_1").isNull()) == 0).alias("no_null_attribution"),
        flag(unmatched < max_unmatched).alias("names_matched"),
    )


def check_observability(df: DataFrame, run_date: str) -> DataFrame:
    rows = df.filter(F.col("run_date") == F.lit(run_date).cast("date"))
    return rows.agg(
        flag(F.count(F.lit(1)) >= 1).alias("has_rows"),
        flag(F.count_if(F.col("pred_occupancy_next_week").isNull()) == 0).alias("no_null_predictions"),
        flag(F.countDistinct("model_name") >= 1).alias("has_models"),
    )


def reconcile(
    raw: DataFrame, observed: DataFrame, served: DataFrame, run_date: str, primary: str = K.PRIMARY_MODEL
) -> DataFrame:
    """One row: counts of the three tables for a run and whether they agree."""
    day = F.col("run_date") == F.lit(run_date).cast("date")
    counts = raw.filter(day).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.col("model_name") == primary).alias("raw_primary_rows"),
    )
    n_observed = observed.filter(day).agg(F.count(F.lit(1)).alias("n")).scalar()
    n_served = served.filter(day).agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        counts.withColumn("observed_rows", n_observed)
        .withColumn("served_rows", n_served)
        .withColumn("observability_ok", F.col("observed_rows") == F.col("raw_rows"))
        .withColumn("serving_ok", F.col("served_rows") == F.col("raw_primary_rows"))
    )


# --- actions: they read one small row and raise ---------------------------------


class TooManyBadRows(RuntimeError):
    """A batch was stopped: ``bad`` of ``total`` rows."""

    def __init__(self, total: int, bad: int, limit: float):
        super().__init__(f"{bad} of {total} rows failed the quality gate (limit {limit:.0%}); nothing was written")
        self.total, self.bad = total, bad


def enforce_max_bad_rate(stats: Row | Mapping[str, object], limit: float = K.MAX_BAD_RATE) -> None:
    total, bad = int(stats["total_rows"]), int(stats["quarantine_rows"])
    if total and bad / total > limit:
        raise TooManyBadRows(total, bad, limit)


def enforce_min_rows(counts: Mapping[str, int], minimum: int) -> None:
    short = {name: n for name, n in counts.items() if n < minimum}
    if short:
        raise ValueError(f"fewer than {minimum} rows: {short}")


def enforce_checks(row: Row) -> None:
    failed = [name for name, value in row.asDict().items() if not value]
    if failed:
        raise ValueError(f"checks failed: {failed}")


def enforce_not_null(df: DataFrame, names: Sequence[str]) -> None:
    nulls = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names]).first()
    broken = {n: v for n, v in nulls.asDict().items() if v}
    if broken:
        raise ValueError(f"NULL in required columns: {broken}")


def enforce_none(found: Mapping[str, DataFrame]) -> None:
    """Stop with the names of the assertions that returned rows."""
    broken = [name for name, rows in found.items() if not rows.isEmpty()]
    if broken:
        raise ValueError(f"failed assertions: {broken}")
