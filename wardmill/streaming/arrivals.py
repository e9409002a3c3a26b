"""Dated files to silver as they arrive: the batch transforms, driven by a file stream.

``availableNow`` processes what is there and stops, so a scheduler can call it
as it would a batch job; the stream's checkpoint remembers which files are done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wardmill.sources.writers import overwrite_partition, upsert_partitions

BATCH = "batch_id"


def file_stream(
    spark: SparkSession, path: str, schema: str | StructType, files_per_batch: int | None = None
) -> DataFrame:
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_silver(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], base: str, checkpoint: str,
    partitions: Sequence[str] = ("exec_date",),
) -> StreamingQuery:
    """Write each micro-batch under its own ``batch_id`` partition.

    A replayed batch overwrites exactly what it wrote before, and a later batch
    of the same date does not touch earlier ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch).withColumn(BATCH, F.lit(batch_id))
        overwrite_partition(rows, base, [*partitions, BATCH])

    return (
        source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_upsert(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
    keys: Sequence[str], partition: str,
) -> StreamingQuery:
    """Merge each micro-batch by key; a replay merges the same rows again and changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_partitions(batch.sparkSession, path, transform(batch), keys, partition)

    return (
        source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
