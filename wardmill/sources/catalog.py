"""Tables and views of the session's catalog.

A table keeps its layout: partitions, and buckets sorted by the columns that joins and windows use, so that readers of
tables with equal buckets need no exchange. Its NOT NULL columns are recorded with it and checked inside the plan of every
insert: a NULL fails the write, and as a write's files only count once all of its tasks are done, the table stays as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.operators.incremental import merge_upsert
from wardmill.schemas import required_columns, struct
from wardmill.session import delete_path, staging_path

#: Table property that names the NOT NULL columns.
REQUIRED = "wardmill.required"


@dataclass(frozen=True)
class Buckets:
    """Rows of equal ``keys`` lie in one of ``n`` files of a partition, sorted by ``order``. A key's rows are never split, so keys are to be entities."""

    n: int
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()


def create_table(
    spark: SparkSession, name: str, ddl: str, partitions: Sequence[str] = (), buckets: Buckets | None = None, location: str | None = None,
) -> None:
    """Create if absent. ``ddl`` holds all columns; the partition columns come last in the table."""
    fields = struct(ddl).fields
    ordered = [f for f in fields if f.name not in partitions] + [f for p in partitions for f in fields if f.name == p]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered)
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"]
    if partitions:
        parts.append(f"PARTITIONED BY ({', '.join(partitions)})")
    if buckets:
        order = f" SORTED BY ({', '.join(buckets.order)})" if buckets.order else ""
        parts.append(f"CLUSTERED BY ({', '.join(buckets.keys)}){order} INTO {buckets.n} BUCKETS")
    if location:
        parts.append(f"LOCATION '{location}'")
    parts.append(f"TBLPROPERTIES ('{REQUIRED}' = '{','.join(required_columns(ddl))}')")
    spark.sql(" ".join(parts))


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """A view that outlives the session where the catalog does."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def required_of(spark: SparkSession, name: str) -> list[str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == REQUIRED).collect()
    return [n for r in rows for n in r["value"].split(",") if n]


def _described(spark: SparkSession, name: str) -> tuple[list[str], Buckets | None]:
    """Partition columns and buckets as the catalog has them."""
    columns = spark.catalog.listColumns(name)
    text = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    names = lambda key: tuple(x.strip(" `") for x in text.get(key, "").strip("[]").split(",") if x.strip(" `"))
    buckets = Buckets(int(text["Num Buckets"]), names("Bucket Columns"), names("Sort Columns")) if "Num Buckets" in text else None
    return [c.name for c in columns if c.isPartition], buckets


def _present(column: str) -> Column:
    value = F.col(column)
    return F.when(value.isNull(), F.raise_error(F.lit(f"NULL in required column {column}")).cast("string")).otherwise(F.lit(""))


def checked(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Rows in the table's column order and types that fail at run time where a required column is NULL."""
    fields = spark.table(name).schema.fields
    missing = [f.name for f in fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{name} needs columns {missing}; there are {df.columns}")
    needed = required_of(spark, name)
    if needed:      # a filter cannot be pruned away, unlike a column that nobody reads
        df = df.filter(F.concat(*[_present(n) for n in needed]) == "")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def _laid_out(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """One task, and so one file, for each bucket; without buckets as many as the sizes ask for."""
    partitions, buckets = _described(spark, name)
    if buckets:
        return df.repartition(buckets.n, *buckets.keys).sortWithinPartitions(*partitions, *buckets.order)
    return df.hint("rebalance", *[F.col(p) for p in partitions]) if partitions else df.hint("rebalance")


def append(spark: SparkSession, name: str, df: DataFrame) -> None:
    _laid_out(spark, name, checked(spark, name, df)).write.mode("append").insertInto(name)


#: Settings that decide what a write does; the session that writes takes them from the caller's.
_SETTINGS = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")


def replace_partitions(spark: SparkSession, name: str, df: DataFrame) -> None:
    """The partitions that occur in the rows are replaced, the others stay; a table without partitions is replaced as a whole.

    The rows are computed into the shared folder first, so they may come from the table itself. Which partitions an insert replaces is a
    setting of the session; a session of its own has it, and the caller's stays as it is.
    """
    staged = staging_path(spark, "replace")
    rows = checked(spark, name, df)
    rows.write.parquet(staged)
    own = spark.newSession()
    for setting in _SETTINGS:
        own.conf.set(setting, spark.conf.get(setting))
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    _laid_out(own, name, own.read.schema(rows.schema).parquet(staged)).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)
    delete_path(spark, staged)


def upsert(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], partition: str) -> None:
    """Merge rows by key into a table partitioned by a date or number; only touched partitions are read and rewritten, in the table's layout."""
    staged = staging_path(spark, "merge")
    batch = checked(spark, name, source)
    batch.write.parquet(staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    if not batch.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"the batch repeats keys {list(keys)}")
    touched = [r[0] for r in batch.select(partition).distinct().collect()]       # as many as partitions
    if touched:
        target = spark.table(name).filter(F.col(partition).isin([v if isinstance(v, (date, int, str)) else str(v) for v in touched]))
        replace_partitions(spark, name, merge_upsert(target, batch, keys))
    delete_path(spark, staged)
