"""The only module with write actions.

Files are laid out with Spark's rebalance hint: adaptive execution splits large
output partitions and merges small ones, so a date that holds a third of the
rows becomes many files written by many tasks and a small dimension becomes one
file, without naming a file count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from wardmill.operators.incremental import merge_upsert, newer_than_target
from wardmill.operators.quality import TooManyBadRows, assert_unique, enforce_max_bad_rate, enforce_min_rows, enforce_not_null
from wardmill.operators.shape import keep_existing
from wardmill.schemas import QUALITY_LOG
from wardmill.session import delete_path, path_exists, replace_folder, sibling_path, staging_path, subfolders

SILVER, QUARANTINE = "silver", "quarantine"
DISPOSITIONS = {"WRITE_APPEND": "append", "WRITE_TRUNCATE": "overwrite"}


def write_mode(disposition: str) -> str:
    if disposition not in DISPOSITIONS:
        raise ValueError(f"unknown write disposition {disposition!r}; expected one of {sorted(DISPOSITIONS)}")
    return DISPOSITIONS[disposition]


def laid_out(df: DataFrame, partitions: Sequence[str] = (), cluster: Sequence[str] = ()) -> DataFrame:
    """Rebalanced by the partition columns and sorted by the cluster columns for row-group skipping."""
    df = df.hint("rebalance", *[F.col(p) for p in partitions]) if partitions else df.hint("rebalance")
    order = [*partitions, *cluster]
    return df.sortWithinPartitions(*order) if order else df


def overwrite_partition(
    df: DataFrame, base: str, partitions: Sequence[str], cluster: Sequence[str] = ()
) -> None:
    """Replace the partitions that occur in ``df`` and leave all others in place."""
    (
        laid_out(df, partitions, cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(base)
    )


def write_table(df: DataFrame, path: str, partitions: Sequence[str] = (), cluster: Sequence[str] = ()) -> None:
    """Full refresh of a table that ``df`` may read: the new one is complete before the old one goes."""
    staged = sibling_path(path, "table")
    writer = laid_out(df, partitions, cluster).write.option("compression", "snappy")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(staged)
    replace_folder(df.sparkSession, staged, path)


def land(df: DataFrame, path: str) -> None:
    """A landed batch as it comes, complete before an earlier one of its place goes."""
    staged = sibling_path(path, "land")
    df.write.option("compression", "snappy").parquet(staged)
    replace_folder(df.sparkSession, staged, path)


def land_as_strings(df: DataFrame, path: str) -> None:
    """Everything as text; NULL stays NULL instead of becoming a text."""
    land(df.select(*[F.col(n).cast("string").alias(n) for n in df.columns]), path)


@dataclass(frozen=True)
class SplitCounts:
    total_rows: int
    clean_rows: int
    quarantine_rows: int

    @property
    def quarantine_rate(self) -> float:
        return self.quarantine_rows / self.total_rows if self.total_rows else 0.0


def _split(df: DataFrame, staged: str, cluster: Sequence[str], required: Sequence[str] = ()) -> tuple[SplitCounts, int]:
    """Writes good and bad rows to two folders in one job, and counts them as they are written; also good rows with all of ``required``.

    The counts are observed in the tasks that write, after the last exchange: a task that is repeated because its executor
    was lost counts once, as its files do.
    """
    seen = Observation()
    bad = F.coalesce(F.col("_has_violation"), F.lit(False))
    routed = df.withColumn("route", F.when(bad, F.lit(QUARANTINE)).otherwise(F.lit(SILVER))).hint("rebalance", F.col("route"))
    whole = F.col("route") == SILVER
    for n in required:
        whole = whole & F.col(n).isNotNull()
    counted = routed.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(F.col("route") == QUARANTINE).alias("bad"), F.count_if(whole).alias("whole"))
    counted.sortWithinPartitions("route", *cluster).write.partitionBy("route").parquet(staged)
    found = seen.get
    return SplitCounts(found["total"], found["total"] - found["bad"], found["bad"]), found["whole"]


def write_split(
    df: DataFrame, base: str, source: str, exec_date: str, max_bad_rate: float | None = None,
    cluster: Sequence[str] = (),
) -> SplitCounts:
    """Good and bad rows of one batch in a single pass, routed by a partition column.

    ``base/source/route=silver|quarantine/exec_date=...``. The batch is computed
    once, into a folder of its own, and counted while it is written; only then do its two
    routes take the place of the date's earlier ones. A route without rows
    leaves none behind, so a rerun holds exactly the new batch. A batch with a larger part of
    bad rows than ``max_bad_rate`` is thrown away and stops the run; the table is as it was.
    """
    spark = df.sparkSession
    target = f"{base}/{source}"
    staged = sibling_path(target, "split")
    bad = F.col("_has_violation")
    counts, _ = _split(df.withColumns({
        "_quarantine_source": F.when(bad, F.lit(source)),
        "_quarantine_date": F.when(bad, F.lit(exec_date)),
    }), staged, cluster)
    _gate(spark, counts, max_bad_rate, staged)
    written = subfolders(spark, staged)
    for route in (SILVER, QUARANTINE):
        place = f"{target}/route={route}/exec_date={exec_date}"
        if f"route={route}" in written:
            replace_folder(spark, f"{staged}/route={route}", place)
        else:
            delete_path(spark, place)
    delete_path(spark, staged)
    return counts


def _gate(spark: SparkSession, counts: SplitCounts, max_bad_rate: float | None, staged: str) -> None:
    if max_bad_rate is None:
        return
    try:
        enforce_max_bad_rate({"total_rows": counts.total_rows, "quarantine_rows": counts.quarantine_rows}, max_bad_rate)
    except TooManyBadRows:
        delete_path(spark, staged)
        raise


def land_checked(
    records: DataFrame, path: str, malformed: str, max_bad_rate: float | None = None, required: Sequence[str] = (),
) -> SplitCounts:
    """Records of ``sources.checked`` in one pass: good ones to ``path``, bad ones, with text, reason and place, to ``malformed``.

    Good records keep the check's columns, all NULL but their place, so that the folder is written once; readers name the
    columns they want. Both places hold this batch only afterwards, also where it has no rows for one. If no good record has all
    the ``required`` columns, the batch does not have the agreed form and stops.
    """
    spark = records.sparkSession
    staged = sibling_path(path, "checked")
    bad = F.col("_has_violation")
    counts, whole = _split(records.withColumn("_record", F.when(bad, F.col("_record"))), staged, (), required)
    _gate(spark, counts, max_bad_rate, staged)
    if counts.clean_rows and not whole:
        delete_path(spark, staged)
        raise ValueError(f"none of {counts.clean_rows} records has all of {list(required)}")
    written = subfolders(spark, staged)
    for route, place in ((SILVER, path), (QUARANTINE, malformed)):
        if f"route={route}" in written:
            replace_folder(spark, f"{staged}/route={route}", place)
        else:
            land(spark.createDataFrame([], records.schema), place)
    delete_path(spark, staged)
    return counts


def quality_row(source: str, exec_date: str, counts: SplitCounts, logged_at: datetime | None = None) -> tuple:
    return (
        source, date.fromisoformat(exec_date), counts.total_rows, counts.clean_rows, counts.quarantine_rows,
        counts.quarantine_rate, logged_at or datetime.now(timezone.utc).replace(tzinfo=None),
    )


def append_quality_log(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    """One row per source and run."""
    spark.createDataFrame(list(rows), QUALITY_LOG).coalesce(1).write.mode("append").parquet(path)


def ensure_table(
    spark: SparkSession, name: str, ddl: str, partitions: Sequence[str] = (), location: str | None = None
) -> None:
    """Create if absent. File tables do not enforce NOT NULL; writers check it before each write."""
    columns = ddl.replace(" NOT NULL", "")
    partitioned = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    where = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioned} {where}")


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_run(
    batch: DataFrame, path: str, run_column: str = "run_date", cluster: Sequence[str] = (),
    required: Sequence[str] = (), disposition: str = "WRITE_APPEND", min_rows: int = 1,
) -> int:
    """Replace the runs in the batch (or the whole table), never with an empty batch; the number of its rows.

    The batch is computed once, into a folder next to the table, checked there, and then moved into place.
    """
    spark, mode = batch.sparkSession, write_mode(disposition)
    staged = sibling_path(path, "run")
    laid_out(batch, [run_column], cluster).write.partitionBy(run_column).parquet(staged)
    try:
        written = spark.read.schema(batch.schema).parquet(staged)
        n = written.count()
        enforce_min_rows({"batch": n}, min_rows)
        if required:
            enforce_not_null(written, required)
    except Exception:
        delete_path(spark, staged)
        raise
    if mode == "append":
        for name in subfolders(spark, staged):
            replace_folder(spark, f"{staged}/{name}", f"{path}/{name}")
        delete_path(spark, staged)
    else:
        replace_folder(spark, staged, path)
    return n


def append_newer(batch: DataFrame, path: str, column: str, cluster: Sequence[str] = ()) -> int:
    """Append the rows past the table's high-water mark, all of them to an absent table; how many there were.

    A table of hive partitions by ``column``. A repeated batch adds nothing. A row without a mark is neither old nor new and stops the run.
    """
    spark = batch.sparkSession
    if not batch.filter(F.col(column).isNull()).isEmpty():
        raise ValueError(f"rows without a {column!r} cannot be told new from old")
    if path_exists(spark, path):
        batch = newer_than_target(spark.read.schema(batch.schema).parquet(path), batch, column)
    staged = sibling_path(path, "append")
    laid_out(batch, [column], cluster).write.partitionBy(column).parquet(staged)
    n = spark.read.schema(batch.schema).parquet(staged).count()
    for name in subfolders(spark, staged):
        replace_folder(spark, f"{staged}/{name}", f"{path}/{name}")
    delete_path(spark, staged)
    return n


def touched_partitions(target: DataFrame, source: DataFrame, partition: str) -> DataFrame:
    """Target rows of the partitions that occur in the source.

    The source's range is a scalar subquery in the partition filter: partitions
    outside it are never listed for reading, so a weekly delta does not scan the
    history. The semi join then drops the untouched ones inside the range.
    """
    first = source.agg(F.min(partition).alias("first")).scalar()
    last = source.agg(F.max(partition).alias("last")).scalar()
    in_range = target.filter((F.col(partition) >= first) & (F.col(partition) <= last))
    return in_range.join(source.select(partition).distinct(), [partition], "left_semi").select(*target.columns)


def upsert_partitions(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition: str,
    since: str | None = None, cluster: Sequence[str] = (),
) -> None:
    """Merge a batch into a partitioned table and rewrite only the partitions it touches.

    The partition column belongs to the key, so a row never changes partition.
    The batch is computed once; it must be unique on the key and name every
    row's partition. Merged partitions are complete in the shared folder before
    the table's are overwritten, and stay there if that fails.
    """
    if partition not in keys:
        raise ValueError(f"partition column {partition!r} must be part of the key {list(keys)}")
    staged_source = staging_path(spark, "batch")
    source.write.parquet(staged_source)
    source = spark.read.schema(source.schema).parquet(staged_source)
    if not source.filter(F.col(partition).isNull()).isEmpty():
        raise ValueError(f"rows without a {partition!r} have no partition to be merged into")
    if not assert_unique(source, list(keys)).isEmpty():
        raise ValueError(f"the batch repeats keys {list(keys)}")
    if not path_exists(spark, path):
        overwrite_partition(source, path, [partition], cluster)
    else:
        target = spark.read.schema(source.schema).parquet(path)
        affected = touched_partitions(target, source, partition)
        staged = staging_path(spark, "upsert")
        merge_upsert(affected, source, keys, since, partition).write.parquet(staged)
        overwrite_partition(spark.read.schema(source.schema).parquet(staged), path, [partition], cluster)
        delete_path(spark, staged)
    delete_path(spark, staged_source)


def replace_keys(
    spark: SparkSession, path: str, keys: DataFrame, rows: DataFrame, partition: str, cluster: Sequence[str] = (),
) -> list[str]:
    """Delete the rows of ``keys``, insert ``rows`` (of such keys), and rewrite only the partitions that the keys name.

    ``keys`` holds the key columns, the partition column (a date) among them. The new partitions are complete in a folder of
    their own before the first one takes its place; a partition without rows left goes. Returns the partitions' values.
    """
    values = sorted(str(r[0]) for r in keys.select(F.col(partition).cast("string")).distinct().collect())
    if not values:
        return []
    target = spark.read.schema(rows.schema).parquet(path).filter(F.col(partition).isin([date.fromisoformat(v) for v in values]))
    kept = target.join(keys.distinct(), keys.columns, "left_anti").select(*rows.columns)
    staged = sibling_path(path, "keys")
    laid_out(kept.unionByName(rows), [partition], cluster).write.partitionBy(partition).parquet(staged)
    written = subfolders(spark, staged)
    for value in values:
        name = f"{partition}={value}"
        if name in written:
            replace_folder(spark, f"{staged}/{name}", f"{path}/{name}")
        else:
            delete_path(spark, f"{path}/{name}")
    delete_path(spark, staged)
    return values


def write_splits(df: DataFrame, path: str, columns: Sequence[str], keep: Sequence[str]) -> None:
    """Model rows with identity, targets and split name; one table partitioned by split."""
    overwrite_partition(keep_existing(df, list(dict.fromkeys([*columns, *keep, "split"]))), path, ["split"])


def split_counts(df: DataFrame) -> dict[str, int]:
    counts = {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {name: counts.get(name, 0) for name in ("train", "val", "test")}


def write_feature_metadata(
    spark: SparkSession, path: str, numeric: Sequence[str], categorical: Sequence[str],
    train_end: str, validation_end: str, counts: Mapping[str, int],
) -> None:
    row = Row(
        numeric_feats=list(numeric), cat_feats=list(categorical), feature_cols=[*numeric, *categorical],
        train_end=train_end, val_end=validation_end, split_counts=dict(counts),
        n_features=len(numeric) + len(categorical),
    )
    ddl = (
        "numeric_feats array<string>, cat_feats array<string>, feature_cols array<string>, train_end string, "
        "val_end string, split_counts map<string, bigint>, n_features int"
    )
    spark.createDataFrame([row], ddl).coalesce(1).write.mode("overwrite").json(path)
