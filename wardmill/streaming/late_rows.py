"""Rows of a stream taken once, and late ones told apart.

A file may be delivered again, and a source corrects rows for some days. A row below the watermark, the newest event seen in
earlier batches less the look-back, is late and goes to a table of its own instead of being dropped. Any other row is taken if its
entity has no row of that date yet, else it is a repeat. State holds each entity's dates taken that are not below the watermark,
so it is bounded by entities times look-back and needs no timer. It is Spark's own, checkpointed with the offsets and the
watermark: a stream that is stopped goes on where it was.

Entities are judged by the bucket, some thousands at once, as a call of Python for each entity costs milliseconds whatever it does.
A bucket's number is a hash of the entity, and their count belongs to the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wardmill.session import importable_in_tasks
from wardmill.sources.writers import overwrite_partition
from wardmill.streaming.arrivals import BATCH

OUTCOME = "outcome"
TAKEN, REPEAT, LATE = "taken", "repeat", "late"
#: Groups of entities with a state each. A checkpoint's count cannot change: entities would lose what was taken of them.
BUCKETS = 2048


def judged(source: DataFrame, entity: Sequence[str], event_date: str, lookback_days: int, buckets: int = BUCKETS) -> DataFrame:
    """All rows of the stream with ``outcome``. Of equal dates in a batch the smallest content comes first; a row without a date is late."""
    importable_in_tasks(source.sparkSession)
    names = source.columns
    longs = [f.name for f in source.schema.fields if isinstance(f.dataType, LongType)]      # a null makes pandas round them
    fields = [StructField(f.name, StringType()) if f.name in longs else f for f in source.schema.fields]
    schema = StructType([*fields, StructField(OUTCOME, StringType())])

    def judge(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        line = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")      # zero in the first batch
        rows = pd.concat(list(parts), ignore_index=True)
        rows = rows.sort_values([event_date, *[n for n in names if n != event_date]], key=lambda c: c.astype(str), kind="stable")
        when = pd.to_datetime(rows["_event_time"], errors="coerce")
        late = when.isna() | (when < line)
        dates = rows[event_date].astype(str) + "\n" + rows["_entity"]      # a date first, so that they order by it
        taken = list(state.get[0]) if state.exists else []
        repeat = dates.isin(taken) | dates.where(~late).duplicated()
        rows[OUTCOME] = np.select([late, repeat], [LATE, REPEAT], TAKEN)
        kept = sorted(d for d in {*taken, *dates[~late]} if d >= str(line.date()))
        if kept:
            state.update((kept,))
        elif state.exists:
            state.remove()
        yield rows[[*names, OUTCOME]]

    own = F.to_json(F.array(*[F.col(k).cast("string") for k in entity]))      # null is one, too
    timed = source.withColumn("_event_time", F.col(event_date).cast("timestamp")).withWatermark("_event_time", f"{lookback_days} days")
    keyed = timed.withColumn("_entity", own).withColumn("_bucket", F.pmod(F.xxhash64("_entity"), F.lit(buckets)))
    rows = keyed.withColumns({n: F.col(n).cast("string") for n in longs}).groupBy("_bucket").applyInPandasWithState(
        judge, schema, "taken array<string>", "append", GroupStateTimeout.NoTimeout)
    return rows.withColumns({n: F.col(n).cast("bigint") for n in longs})


def stream_once(
    source: DataFrame, entity: Sequence[str], event_date: str, base: str, checkpoint: str, lookback_days: int = 3, buckets: int = BUCKETS,
) -> StreamingQuery:
    """Writes what has arrived to ``base/outcome=taken|repeat|late/batch_id=...`` and stops; a replayed batch overwrites its own rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        overwrite_partition(batch.withColumn(BATCH, F.lit(batch_id)), base, [OUTCOME, BATCH])

    rows = judged(source, entity, event_date, lookback_days, buckets)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
