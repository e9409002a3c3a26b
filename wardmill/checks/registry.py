"""Registry of checked queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Lazy access to the Parquet tables of one directory."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = df
        return df


@dataclass(frozen=True)
class Check:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


CHECKS: dict[str, Check] = {}


def check(covers: str, sql: str | None = None) -> Callable:
    """Register a query under its function name; ``covers`` lists the inventory ids it exercises."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = build.__name__
        if name in CHECKS:
            raise ValueError(f"query {name} is registered twice")
        CHECKS[name] = Check(name, tuple(covers.split()), build, sql)
        return build

    return register


def load_all() -> dict[str, Check]:
    from wardmill.checks import columns, files, malformed, models, panels, quality, reports, tables  # noqa: F401

    return CHECKS
