"""Typed scans. Schemas are given, so no scan infers types or reads footers to guess them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wardmill.operators.shape import stack
from wardmill.session import child_names, path_exists


def _schema(schema: str | StructType) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_dated(
    spark: SparkSession, root: str, source: str, exec_date: str, schema: str | StructType
) -> DataFrame:
    """One source's Parquet of one date: ``root/source/exec_date/data.parquet``."""
    return spark.read.schema(_schema(schema)).parquet(f"{root}/{source}/{exec_date}/data.parquet")


def read_glob(spark: SparkSession, root: str, pattern: str, schema: str | StructType) -> DataFrame:
    """Every file under ``root`` whose name matches the pattern."""
    return spark.read.schema(_schema(schema)).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).parquet(root)


def landed_folder(spark: SparkSession, root: str, exec_date: str) -> str:
    """The newest dated folder up to the date; ``root`` itself where nothing lies in dated folders."""
    dated = [n for n in child_names(spark, root) if len(n) == 10 and n[4] == n[7] == "-" and n.replace("-", "").isdecimal()]
    if not dated:
        return root
    if min(dated) > exec_date:
        raise FileNotFoundError(f"nothing landed under {root} up to {exec_date}")
    return f"{root}/{max(n for n in dated if n <= exec_date)}"


def with_lineage(df: DataFrame, source: str, as_of: str) -> DataFrame:
    return df.withColumns({"_source_file": F.lit(source), "_ingested_at": F.lit(as_of).cast("timestamp")})


def with_source_path(df: DataFrame, name: str = "source_file_path") -> DataFrame:
    return df.withColumn(name, F.col("_metadata.file_path"))


def read_external(
    spark: SparkSession, base: str, schema: str | StructType, partitions: Sequence[str] = ("exec_date",)
) -> DataFrame:
    """Hive-partitioned Parquet with a fixed schema; partition values stay text."""
    full = StructType([*_schema(schema).fields, *[StructField(p, StringType()) for p in partitions]])
    return spark.read.schema(full).option("basePath", base).parquet(base)


def read_partition(
    spark: SparkSession, base: str, schema: str | StructType, exec_date: str, partition: str = "exec_date"
) -> DataFrame:
    """One partition. The date is a required argument, so a full scan cannot happen by accident."""
    return read_external(spark, base, schema, [partition]).filter(F.col(partition) == exec_date)


def read_latest_vintage(
    spark: SparkSession, template: str, vintages: Sequence[int | str],
    read: Callable[[str], DataFrame], alias: str = "vintage",
) -> DataFrame:
    """First vintage in the given order whose path exists; the vintage is kept as a column."""
    for v in vintages:
        path = template.format(v)
        if path_exists(spark, path):
            return read(path).withColumn(alias, F.lit(v))
    raise FileNotFoundError(f"no vintage of {list(vintages)} under {template}")


def read_vintages(parts: Sequence[tuple[int, DataFrame]], alias: str = "data_year") -> DataFrame:
    """Vintages with different columns as one table, each row tagged with its year."""
    return stack([df.withColumn(alias, F.lit(year)) for year, df in parts], allow_missing=True)


def read_splits(spark: SparkSession, root: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(root)
    return df if split is None else df.filter(F.col("split") == split)


def pushed_range(column: str, start: str, end: str) -> Column:
    """Bare column against date literals, the form a scan can use."""
    return F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
