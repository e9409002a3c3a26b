"""Renames, projections, typed schemas and small schema decisions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.constants import CATEGORICAL_FEATURES, LEAKAGE_KEYWORDS, NON_FEATURES, PIPELINE_VERSION
from wardmill.schemas import field_types


def rename_existing(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def keep_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[n for n in names if n in df.columns])


def project_typed(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Select and cast in the order of ``spec``; a bad value raises under ANSI."""
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in spec.items()])


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Shape a batch to a write schema: its order, its types, NULL for bad or absent values."""
    return df.select(*[
        (F.col(n).try_cast(t) if n in df.columns else F.lit(None).cast(t)).alias(n)
        for n, t in field_types(ddl).items()
    ])


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items() if n in df.columns})


def null_sentinels(df: DataFrame, names: Sequence[str], value: float) -> DataFrame:
    present = [n for n in names if n in df.columns]
    return df.withColumns({n: F.when(F.col(n) != value, F.col(n)) for n in present}) if present else df


def col_or_default(df: DataFrame, name: str, default: object) -> Column:
    """The column with NULLs replaced, or the default itself where the frame lacks it."""
    return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)


def with_audit(df: DataFrame, as_of: str, version: str = PIPELINE_VERSION) -> DataFrame:
    """Audit columns from the run's own time, so that a rerun writes equal rows."""
    return df.withColumns({
        "processed_at": F.lit(as_of).cast("timestamp"),
        "pipeline_version": F.lit(version),
        "is_active": F.lit(True),
    })


def align_features(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add absent feature columns as NULL and say which ones they were."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        df = df.withColumns({n: F.lit(None).cast("double") for n in missing})
    return df, missing


def select_features(
    names: Sequence[str],
    excluded: Sequence[str] = NON_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature names, both in schema order."""
    features = [n for n in names if n not in excluded]
    return [n for n in features if n not in categorical], [n for n in features if n in categorical]


def assert_no_leakage(names: Sequence[str], keywords: Sequence[str] = LEAKAGE_KEYWORDS) -> None:
    leaking = [n for n in names if any(k in n.lower() for k in keywords)]
    if leaking:
        raise ValueError(f"feature names hint at the target: {leaking}")


def require_features(names: Sequence[str], expected: Sequence[str]) -> None:
    if list(names) != list(expected):
        raise ValueError(
            f"feature matrix has {len(names)} columns, the model was trained on {len(expected)}; "
            f"absent: {sorted(set(expected) - set(names))}, unknown: {sorted(set(names) - set(expected))}"
        )


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}; available: {df.columns}")
    return df


def normalise_headers(
    df: DataFrame, case: str = "upper", aliases: Mapping[str, str] | None = None, blanks: bool = True
) -> DataFrame:
    names = []
    for n in df.columns:
        n = n.lstrip("﻿").strip()
        n = n.upper() if case == "upper" else n.lower() if case == "lower" else n
        names.append(n.replace(" ", "_") if blanks else n)
    return df.toDF(*[(aliases or {}).get(n, n) for n in names])


def find_column(names: Sequence[str], accept: Callable[[str], bool]) -> str | None:
    return next((n for n in names if accept(n)), None)


def unique_names(labels: Sequence[str]) -> list[str]:
    """Repeated names get ``_1``, ``_2``, ... in order of appearance."""
    seen: dict[str, int] = {}
    result = []
    for label in labels:
        n = seen.get(label, 0)
        result.append(f"{label}_{n}" if n else label)
        seen[label] = n + 1
    return result


def apply_layout_names(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rename by position; columns beyond the shorter list keep their names."""
    names = list(df.columns)
    new = unique_names(labels)[: len(names)]
    return df.toDF(*new, *names[len(new):])


def pivot_first(
    df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]
) -> DataFrame:
    """Long to wide with one non-null value per cell.

    ``names`` is explicit, so no job runs to discover it, and every cell is a
    map-side combined ``min``: unlike "first", it does not depend on row order.
    Rows with a NULL key are dropped.
    """
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[F.min(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])
    )


def split_valid(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(good, bad); a condition that is NULL counts as bad, so no row is lost."""
    good = F.coalesce(condition, F.lit(False))
    return df.filter(good), df.filter(~good)


def filter_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Case-insensitive equality on several columns, those that exist."""
    for n, wanted in labels.items():
        if n in df.columns:
            df = df.filter(F.lower(F.trim(F.col(n))) == wanted.lower())
    return df


def valid_codes(df: DataFrame, name: str, required: Sequence[str] = (), digits: int = 5) -> DataFrame:
    return df.dropna(subset=[name, *required]).filter(F.col(name).rlike(rf"^\d{{{digits}}}$"))


def name_search(df: DataFrame, name: str, keyword: str) -> DataFrame:
    return df.filter(F.contains(F.lower(F.col(name)), F.lit(keyword.lower())))


def stack(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    if not frames:
        raise ValueError("nothing to stack")
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=allow_missing)
    return result


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Sorted head of a report; plans as TakeOrderedAndProject."""
    return df.orderBy(*order).limit(n)
