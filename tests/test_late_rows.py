from __future__ import annotations

import datetime

from conftest import rows

from wardmill.streaming.arrivals import file_stream
from wardmill.streaming.late_rows import stream_once

DDL = "k string, d date, v int"


def day(i):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=i)


DELIVERIES = [
    [("a", day(10), 1), ("b", day(4), 1), ("b", day(5), 2), (None, day(9), 1), ("z", None, 1)],
    [("a", day(10), 1), ("c", day(7), 1), ("d", day(6), 1), ("e", day(30), 1), (None, day(9), 1)],          # the line is day 7: d is late
    [("c", day(28), 3), ("c", day(28), 2), ("f", day(20), 1), (None, day(9), 1)],       # now it is day 27
]
WANT = [("a", day(10), 1, "repeat"), ("a", day(10), 1, "taken"), ("b", day(4), 1, "taken"), ("b", day(5), 2, "taken"), ("c", day(7), 1, "taken"),
        ("c", day(28), 2, "taken"), ("c", day(28), 3, "repeat"), ("d", day(6), 1, "late"), ("e", day(30), 1, "taken"), ("f", day(20), 1, "late"),
        ("z", None, 1, "late"), (None, day(9), 1, "taken"), (None, day(9), 1, "repeat"), (None, day(9), 1, "late")]


def run(spark, folder, data=None):
    if data is not None:
        spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream_once(file_stream(spark, f"{folder}/in", DDL, files_per_batch=1), ["k"], "d", f"{folder}/out", f"{folder}/cp").awaitTermination(60)
    return sorted(rows(spark.read.schema(f"{DDL}, outcome string").parquet(f"{folder}/out").drop("batch_id")), key=str)


def test_rows_are_taken_once_across_restarts(spark, folder):
    for data in DELIVERIES:
        got = run(spark, folder, data)
    assert got == sorted(WANT, key=str)
    assert run(spark, folder) == got                       # nothing new



def test_entities_share_a_state_and_stay_apart(spark, folder):
    """Some calls of Python for all entities, not one for each; a null beside a large key does not round it."""
    ddl, big = "k string, d date, v bigint", 2**53 + 1
    first = [(f"e{i}", day(i % 20), big + i) for i in range(300)]
    again = [(f"e{i}", day(i % 20 + i % 2), None if i == 7 else big) for i in range(300)]          # the line is day 16
    for data in (first, again):
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        q = stream_once(file_stream(spark, f"{folder}/in", ddl), ["k"], "d", f"{folder}/out", f"{folder}/cp", 3, buckets=4)
        q.awaitTermination(60)
        assert q.recentProgress[0]["stateOperators"][0]["numRowsTotal"] <= 4
    late = [(*r, "late" if r[1] < day(16) else "taken" if int(r[0][1:]) % 2 else "repeat") for r in again]
    got = spark.read.schema(f"{ddl}, outcome string").parquet(f"{folder}/out").drop("batch_id")
    assert sorted(rows(got), key=str) == sorted([*((*r, "taken") for r in first), *late], key=str)
