"""Session and shared-folder helpers for jobs, bench and tests.

Library code never changes the session it is given; only entry points that own
their process build one here.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession


def build_session(app_name: str, master: str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None, settings: Mapping[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def importable_in_tasks(spark: SparkSession) -> None:
    """Functions that run in tasks import this package by name; workers that start from now on find it where the driver did."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share: ``spark.checkpoint.dir``, else the warehouse; never a machine's own one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not folder:
        raise ValueError("the session names no shared folder; set spark.checkpoint.dir")
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def staging_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/staging/{purpose}-{uuid.uuid4().hex}"


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return bool(fs.exists(hadoop_path))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, hadoop_path = _filesystem(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a finished folder in the place of another on the same file system; the old one goes only after the new one is complete."""
    fs, new = _filesystem(spark, source)
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sibling_path(target, "old")) if fs.exists(old) else None
    fs.mkdirs(old.getParent())
    if aside is not None and not fs.rename(old, aside):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(new, old):
        if aside is not None:
            fs.rename(aside, old)
        raise OSError(f"cannot move {source} to {target}")
    if aside is not None:
        fs.delete(aside, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly inside ``path``."""
    fs, hadoop_path = _filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()) if fs.exists(hadoop_path) else []


def sibling_path(path: str, purpose: str) -> str:
    """A new folder next to ``path``, which readers of the tables around it pass over."""
    base, _, name = path.rstrip("/").rpartition("/")
    return f"{base}/_{purpose}-{name}-{uuid.uuid4().hex}"
