from __future__ import annotations

import pytest


@pytest.fixture()
def table(spark, tmp_path):
    """Rows as a small Parquet table, spread over several files like real input."""
    made = []

    def make(data, ddl, parts=3):
        path = f"{tmp_path}/t{len(made)}"
        made.append(path)
        spark.createDataFrame(data, ddl).repartition(parts).write.parquet(path)
        return spark.read.schema(spark.createDataFrame([], ddl).schema).parquet(path)

    return make
