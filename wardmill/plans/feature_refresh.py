"""The feature store kept up to date by its changed rows.

Next to the table lie the keys of fact rows that were merged and not yet taken up, each facility's first and last week, the
attributes that the rows were joined with, and the last run date. A refresh reads the fact's partitions around the changed
weeks only, recomputes the rows that a changed row can reach, and rewrites only the weeks of those. Keys are noted
before the fact is merged and dropped after the table is complete, so a run that fails is made good by the next one.

All rows are built anew where a change reaches all weeks anyway: attributes of a known facility changed (a new census year
changes them all), or there is no table yet.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.operators.halo import ISLAND, in_stretches, island_of, islands, short_of_rows, with_reach
from wardmill.operators.panel import panel_filter
from wardmill.plans.features import LAGS, ROLLING, base_panel, feature_rows, with_history
from wardmill.session import delete_path, path_exists, staging_path, subfolders
from wardmill.sources.writers import replace_keys, write_table

ENTITY, WEEK, FACT_WEEK = "hospital_id", "report_date", "collection_week"
#: Rows that a feature looks back and ahead.
BACK = max(*(n for items in LAGS.values() for n, _ in items), *(n - 1 for items in ROLLING.values() for n, _ in items))
AHEAD = 1
KEYS = f"{ENTITY} string, {WEEK} date"


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: weeks read from the fact, weeks rewritten; None means all."""

    read: tuple[tuple[str, str], ...] | None
    rewritten: tuple[str, ...] | None


@dataclass(frozen=True)
class Dimensions:
    dates: DataFrame
    attributes: DataFrame


def note_changes(spark: SparkSession, path: str, keys: DataFrame) -> None:
    """Keys of fact rows that are about to be merged: new, corrected or withdrawn."""
    keys.select(F.col(ENTITY).cast("string").alias(ENTITY), F.col(FACT_WEEK).cast("date").alias(WEEK)).write.mode("append").parquet(
        f"{_state(path)}/pending/{staging_path(spark, 'keys').rsplit('/', 1)[1]}")


def refresh_features(
    spark: SparkSession, path: str, fact_path: str, dimensions: Dimensions, as_of: str, start: str | None = None,
) -> Refresh:
    """Brings the table to what ``feature_weekly`` would build from the whole fact, up to the newest ``as_of`` so far."""
    state = _state(path)
    partitions = [x.partition("=")[2] for x in subfolders(spark, fact_path) if x.startswith(f"{FACT_WEEK}=")]
    newest = spark.read.option("basePath", fact_path).parquet(f"{fact_path}/{FACT_WEEK}={partitions[-1]}")      # its columns, not those of any old file
    fact = spark.read.schema(newest.schema).parquet(fact_path)
    pending = subfolders(spark, f"{state}/pending")
    attributes = _kept(dimensions.attributes, "attributes")
    if not all(path_exists(spark, x) for x in (path, f"{state}/spans", f"{state}/attributes", f"{state}/through")) or _attributes_changed(spark, state, attributes):
        return _built(spark, path, fact, dimensions.dates, attributes, as_of, start, pending)
    through = str(spark.read.parquet(f"{state}/through").first()["through"])
    end = max(through, as_of)
    changed = _changed(spark, state, pending, fact, through, end, start)
    weeks = [str(r[0]) for r in changed.select(F.col(WEEK).cast("string")).distinct().collect()]     # as many as partitions
    done = Refresh((), ())
    if weeks:
        spans = spark.read.parquet(f"{state}/spans")
        stretches = _wide_enough(fact, changed, spans, partitions, weeks, start, end)
        done = _recomputed(spark, path, fact, dimensions.dates, attributes, changed, spans, stretches, start, end, as_of)
    _close(spark, path, end, pending)
    return done


def _state(path: str) -> str:
    return f"{path.rstrip('/')}_state"


def _kept(df: DataFrame, name: str) -> DataFrame:
    """A small result computed once, in the shared folder."""
    place = staging_path(df.sparkSession, name)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def _attributes_changed(spark: SparkSession, state: str, attributes: DataFrame) -> bool:
    """Whether rows that were joined, or that found nothing to be joined with, would be joined with something else now."""
    before = spark.read.parquet(f"{state}/attributes")
    if set(before.columns) != set(attributes.columns):
        return True
    entities = before.select(ENTITY).unionByName(spark.read.parquet(f"{state}/spans").select(ENTITY))
    known = attributes.join(entities, [ENTITY], "left_semi").select(*before.columns)
    return not (known.exceptAll(before).isEmpty() and before.exceptAll(known).isEmpty())


def _changed(spark: SparkSession, state: str, pending: list[str], fact: DataFrame, through: str, end: str, start: str | None) -> DataFrame:
    """Noted keys, and the rows of weeks that only now are up to date."""
    newer = fact.filter((F.col(FACT_WEEK) > F.lit(through).cast("date")) & (F.col(FACT_WEEK) <= F.lit(end).cast("date")))
    keys = newer.select(F.col(ENTITY).cast("string").alias(ENTITY), F.col(FACT_WEEK).cast("date").alias(WEEK))
    if pending:
        keys = keys.unionByName(spark.read.schema(KEYS).parquet(*[f"{state}/pending/{x}" for x in pending]))
    keys = keys.filter(F.col(ENTITY).isNotNull() & (F.col(WEEK) <= F.lit(end).cast("date")))
    if start is not None:
        keys = keys.filter(F.col(WEEK) >= F.lit(start).cast("date"))
    return _kept(keys.distinct(), "changed")


def _context(fact: DataFrame, changed: DataFrame, stretches: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """The fact's rows of the changed facilities in the stretches, and the changed keys with the stretch each lies in."""
    rows = fact.filter(in_stretches(F.col(FACT_WEEK), stretches)).join(changed.select(ENTITY).distinct(), [ENTITY], "left_semi")
    nearest = F.coalesce(island_of(F.col(WEEK), stretches), F.lit(-1))
    return rows, changed.withColumn(ISLAND, nearest).filter(F.col(ISLAND) >= 0)


def _wide_enough(fact: DataFrame, changed: DataFrame, spans: DataFrame, partitions: list[str], weeks: list[str], start: str | None, end: str) -> list[tuple[str, str]]:
    """Stretches that hold all neighbours of the changed rows; only key columns are read to find out."""
    reach = dict.fromkeys(weeks, BACK + AHEAD + 1)
    while True:
        stretches = islands(partitions, reach)
        rows, keys = _context(fact, changed, stretches)
        panel = base_keys(rows, start, end).withColumn(ISLAND, island_of(F.col(WEEK), stretches))
        reached = with_reach(panel, keys, ENTITY, WEEK, BACK, AHEAD)
        short = short_of_rows(reached, spans, stretches, partitions, ENTITY, WEEK, BACK, AHEAD).collect()
        if not short:
            return stretches
        for r in short:
            reach[str(r[0])] *= 2


def base_keys(fact: DataFrame, start: str | None, end: str) -> DataFrame:
    return panel_filter(fact, "inpatient_beds_capacity", FACT_WEEK, start, end).select(ENTITY, F.col(FACT_WEEK).alias(WEEK))


def _recomputed(
    spark: SparkSession, path: str, fact: DataFrame, dates: DataFrame, attributes: DataFrame, changed: DataFrame, spans: DataFrame,
    stretches: list[tuple[str, str]], start: str | None, end: str, as_of: str,
) -> Refresh:
    rows, keys = _context(fact, changed, stretches)
    panel = base_panel(rows, dates, start, end).withColumn(ISLAND, island_of(F.col(WEEK), stretches))
    reached = with_reach(panel, keys, ENTITY, WEEK, BACK, AHEAD)
    affected = _kept(with_history(reached, [ENTITY, ISLAND, "_real"]).filter("_affected"), "affected")
    new = feature_rows(affected, attributes, as_of)
    gone = affected.select(ENTITY, WEEK).unionByName(changed)
    rewritten = replace_keys(spark, path, gone, new, WEEK, [ENTITY, "state"])
    seen = base_keys(rows, start, end).groupBy(ENTITY).agg(F.min(WEEK).alias("first"), F.max(WEEK).alias("last"))
    both = spans.unionByName(seen).groupBy(ENTITY).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    write_table(both, f"{_state(path)}/spans")
    write_table(attributes, f"{_state(path)}/attributes")
    return Refresh(tuple(stretches), tuple(rewritten))


def _built(
    spark: SparkSession, path: str, fact: DataFrame, dates: DataFrame, attributes: DataFrame, as_of: str, start: str | None, pending: list[str],
) -> Refresh:
    state = _state(path)
    end = max(as_of, str(spark.read.parquet(f"{state}/through").first()["through"])) if path_exists(spark, f"{state}/through") else as_of
    panel = base_panel(fact, dates, start, end)
    write_table(feature_rows(with_history(panel), attributes, as_of), path, [WEEK], [ENTITY, "state"])
    spans = base_keys(fact, start, end).groupBy(ENTITY).agg(F.min(WEEK).alias("first"), F.max(WEEK).alias("last"))
    write_table(spans, f"{state}/spans")
    write_table(attributes, f"{state}/attributes")
    _close(spark, path, end, pending)
    return Refresh(None, None)


def _close(spark: SparkSession, path: str, through: str, pending: list[str]) -> None:
    """The last step: the date is moved on, then the keys that were taken up are dropped."""
    state = _state(path)
    write_table(spark.createDataFrame([(date.fromisoformat(through),)], "through date"), f"{state}/through")
    for name in pending:
        delete_path(spark, f"{state}/pending/{name}")
