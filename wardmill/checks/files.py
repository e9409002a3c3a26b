"""Sources and sinks as round trips: a given table is written in a format and read back by the library.

Every file lies in the session's shared folder, so executors on other machines see it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.checks.registry import Tables, check
from wardmill.operators.panel import temporal_split
from wardmill.operators.shape import stack
from wardmill.session import staging_path
from wardmill.sources import catalog as C
from wardmill.sources import readers as R
from wardmill.sources import text_formats as X
from wardmill.sources import writers as W
from wardmill.streaming.arrivals import file_stream, stream_silver
from wardmill.streaming.late_rows import stream_once

c = F.col


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderstatus", c("o_orderpriority"), c("o_custkey"), c("o_orderdate").cast("date").alias("d"))


def _years(t: Tables) -> DataFrame:
    return _orders(t).withColumn("year", F.year("d").cast("string"))


ORDERS = "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders"
TEXTS = f"SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(d AS VARCHAR) AS d FROM ({ORDERS}) o"


@check("SC06 SK05", TEXTS)
def delimited_round_trip(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "delimited")
    _orders(t).write.option("header", True).option("sep", "|").csv(path)
    return X.read_delimited(t.spark, path, "|", columns=["o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey", "d"])


@check("SC07 SC08", """
SELECT p_brand AS "NETWORK", CAST(p_partkey AS VARCHAR) AS "SEASON_YEAR", CAST(p_size AS VARCHAR) AS "MMWR_YEAR", 'x' AS "CATCHMENT" FROM part
""")
def preamble_round_trip(t: Tables) -> DataFrame:
    """Many files, each with its own free text and header in front of its rows."""
    path = staging_path(t.spark, "preamble")
    line = F.concat_ws(",", F.lit("x"), c("p_brand"), c("p_partkey").cast("string"), c("p_size").cast("string"))
    body = t.part.select(F.floor(c("p_partkey") / 20000).alias("file"), F.lit(2).alias("at"), line.alias("value"))
    front = F.array(F.struct(F.lit(0).alias("at"), F.lit("Some notes, and a disclaimer").alias("value")),
                    F.struct(F.lit(1).alias("at"), F.lit("CATCHMENT,NETWORK,YEAR,YEAR").alias("value")))
    heads = body.select("file").distinct().select("file", F.inline(front))
    files = heads.unionByName(body).repartition("file").sortWithinPartitions("file", "at")
    files.select("file", "value").write.partitionBy("file").text(path)
    got = X.read_csv_with_preamble(t.spark, path, ["CATCHMENT"], {"YEAR": ["SEASON_YEAR", "MMWR_YEAR"]})
    return got.select("NETWORK", "SEASON_YEAR", "MMWR_YEAR", "CATCHMENT")


@check("SC10 SC11", """
SELECT CAST(p_partkey AS VARCHAR) AS "Part_Key", p_brand AS "Label", CAST(p_size AS VARCHAR) AS "Label_1" FROM part
""")
def fixed_width_round_trip(t: Tables) -> DataFrame:
    data, layout = staging_path(t.spark, "fixed"), staging_path(t.spark, "layout")
    key, brand, size = F.lpad(c("p_partkey").cast("string"), 12, " "), F.rpad("p_brand", 10, " "), F.lpad(c("p_size").cast("string"), 4, " ")
    t.part.select(F.concat(key, brand, size)).write.text(data)
    fields = ["@00001 f1 12. /*Part Key*/", "@00013 f2 $ 10. /*Label*/", "@00023 f3 4. /*Label*/"]
    t.region.limit(1).select(F.explode(F.array(*[F.lit(x) for x in fields]))).write.text(layout)
    return X.read_fixed_width(t.spark, data, X.read_layout(t.spark, layout))


@check("SC14", TEXTS)
def json_matrix_round_trip(t: Tables) -> DataFrame:
    """A payload per customer group, half of them with the columns in another order."""
    path = staging_path(t.spark, "matrix")
    names = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey", "d"]

    def payload(order: list[str]) -> Column:
        rows = F.collect_list(F.array(*[c(n).cast("string") for n in order]))
        return F.to_json(F.concat(F.array(F.array(*[F.lit(n) for n in order])), rows))

    grouped = _orders(t).groupBy(F.floor(c("o_orderkey") / 1000).alias("g")).agg(payload(names).alias("one"), payload(names[::-1]).alias("other"))
    grouped.select(F.when(c("g") % 2 == 0, c("one")).otherwise(c("other")).alias("value")).write.text(path)
    return X.rows_from_json_matrix(t.spark.read.text(path), "value", names)


@check("SC15", TEXTS)
def json_records_round_trip(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "records")
    _orders(t).write.json(path)
    return X.read_json_records(t.spark, path).select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey", "d")


@check("SC01", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def dated_source(t: Tables) -> DataFrame:
    """Two dates of one source are landed, one is read."""
    root = staging_path(t.spark, "dated")
    for day, status in (("2024-01-01", "F"), ("2024-01-08", "O")):
        W.land(t.orders.filter(c("o_orderstatus") == status).select("o_orderkey", "o_orderstatus"), f"{root}/orders/{day}/data.parquet")
    return R.read_dated(t.spark, root, "orders", "2024-01-01", "o_orderkey bigint, o_orderstatus string")


@check("SC02 SC05 SK06", "SELECT o_orderkey, o_orderstatus, TRUE AS has_path FROM orders")
def landed_files_by_pattern(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "landed")
    for status in ("F", "O", "P"):
        W.land(t.orders.filter(c("o_orderstatus") == status).select("o_orderkey", "o_orderstatus"), f"{path}/{status}")
    rows = R.with_source_path(R.read_glob(t.spark, path, "*.parquet", "o_orderkey bigint, o_orderstatus string"))
    return rows.select("o_orderkey", "o_orderstatus", c("source_file_path").contains("landed").alias("has_path"))


@check("SC04 SC18 SK01 SK02 SK18", """
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders WHERE year(o_orderdate) = 1996
""")
def external_partition(t: Tables) -> DataFrame:
    """All years are written, one is written again, one is read."""
    path = staging_path(t.spark, "external")
    rows = _years(t).select("o_orderkey", "year")
    for part in (rows, rows.filter("year = '1996'")):
        W.overwrite_partition(part, path, ["year"], ["o_orderkey"])
    return R.read_partition(t.spark, path, "o_orderkey bigint", "1996", "year")


@check("SC12 SC13", """
SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus, 2021 AS data_year FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, NULL, o_orderstatus, 2022 FROM orders WHERE o_orderstatus = 'F'
""")
def stacked_vintages(t: Tables) -> DataFrame:
    """Two vintages with different columns; the later one is found as the newest that exists."""
    root = staging_path(t.spark, "vintages")
    W.land(t.orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_custkey"), f"{root}/v2021")
    W.land(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"), f"{root}/v2022")
    newest = R.read_latest_vintage(t.spark, f"{root}/v{{}}", [2024, 2023, 2022, 2021], t.spark.read.parquet, "vintage")
    got = R.read_vintages([(2021, t.spark.read.parquet(f"{root}/v2021")), (2022, newest.drop("vintage"))])
    return got.select("o_orderkey", "o_custkey", "o_orderstatus", "data_year")


@check("SK03 SK04 Q01", """
SELECT route, COUNT(*) AS n, MIN(o_orderkey) AS first_key, MAX(o_orderkey) AS last_key
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'quarantine' ELSE 'silver' END AS route FROM orders) r GROUP BY 1
""")
def split_round_trip(t: Tables) -> DataFrame:
    """An earlier run with other rows of the same date is replaced as a whole."""
    base = staging_path(t.spark, "split")
    rows = t.orders.select("o_orderkey", c("o_orderstatus"))
    for bad in ("o_orderstatus <> 'P'", "o_orderstatus = 'P'"):
        W.write_split(rows.withColumn("_has_violation", F.expr(bad)), base, "orders", "2024-01-01")
    written = t.spark.read.schema("o_orderkey bigint, route string, exec_date string").parquet(f"{base}/orders")
    return written.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@check("SK08 SK10 SK11", """
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year,
  CASE WHEN o_orderkey % 3 = 0 AND year(o_orderdate) >= 1997 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey FROM orders
""")
def upsert_round_trip(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "fact")
    rows = _years(t).select("o_orderkey", "o_custkey", "year")
    changed = rows.filter("o_orderkey % 3 = 0 AND year >= '1997'").withColumn("o_custkey", c("o_custkey") + 1)
    for batch in (rows, changed, changed):
        W.upsert_partitions(t.spark, path, batch, ["o_orderkey", "year"], "year")
    return t.spark.read.schema("o_orderkey bigint, o_custkey bigint, year string").parquet(path)


@check("SK12 SK13 SK14", f"""
SELECT d AS run_date, COUNT(*) AS n, SUM(o_custkey) AS total FROM ({ORDERS}) o GROUP BY 1
""")
def runs_round_trip(t: Tables) -> DataFrame:
    """Older runs are written, one is replaced, newer ones are appended twice."""
    path = staging_path(t.spark, "runs")
    rows = _orders(t).select("o_orderkey", c("o_custkey").cast("bigint").alias("o_custkey"), F.trunc("d", "year").alias("run_date"), "d")
    old = rows.filter(c("run_date") < F.lit("1997-01-01").cast("date"))
    W.write_run(old.withColumn("o_custkey", F.lit(0).cast("bigint")), path)
    W.write_run(old, path, required=["o_orderkey"])
    for _ in range(2):
        W.append_newer(rows, path, "run_date")
    read = t.spark.read.schema(rows.schema).parquet(path)
    return read.groupBy(c("d").alias("run_date")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("total"))


@check("SK07 SK09", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def table_and_view(t: Tables) -> DataFrame:
    """Rows come through the created table and the view over it; a batch with a NULL key fails and leaves nothing."""
    path = staging_path(t.spark, "table")
    name = "orders_" + path.rsplit("-", 1)[-1]
    rows = _orders(t).select("o_orderkey", "d", F.year("d").alias("year"))
    for _ in range(2):
        C.create_table(t.spark, name, "year int NOT NULL, o_orderkey bigint NOT NULL, d date", ["year"], location=path)
    C.append(t.spark, name, rows)
    try:
        C.append(t.spark, name, rows.withColumn("o_orderkey", F.when(c("o_orderkey") % 100 > 0, c("o_orderkey"))))
    except Exception as e:  # noqa: BLE001
        if "NULL in required column o_orderkey" not in str(e):
            raise
    C.create_view(t.spark, f"{name}_view", f"SELECT o_orderkey, d, year FROM {name}")
    return t.spark.table(f"{name}_view")


@check("SK18 SK10 SK11", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 AND year(o_orderdate) >= 1997 THEN -o_totalprice ELSE o_totalprice END AS price,
  c_mktsegment, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nth
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def bucketed_star_join(t: Tables) -> DataFrame:
    """Two tables with equal buckets: the join and the window over the key need no exchange, also after an upsert."""
    names = ["orders", "customers"]
    places = {n: staging_path(t.spark, n) for n in names}
    orders, customers = (f"{n}_{places[n].rsplit('-', 1)[-1]}" for n in names)
    C.create_table(t.spark, orders, "o_orderkey bigint NOT NULL, o_custkey bigint NOT NULL, price double, year int NOT NULL", ["year"],
                   C.Buckets(8, ("o_custkey",), ("o_custkey", "o_orderkey")), places["orders"])
    C.create_table(t.spark, customers, "o_custkey bigint NOT NULL, c_mktsegment string", buckets=C.Buckets(8, ("o_custkey",), ("o_custkey",)), location=places["customers"])
    rows = t.orders.select("o_orderkey", "o_custkey", c("o_totalprice").alias("price"), F.year(c("o_orderdate").cast("date")).alias("year"))
    C.append(t.spark, orders, rows)
    C.append(t.spark, customers, t.customer.select(c("c_custkey").alias("o_custkey"), "c_mktsegment"))
    changed = rows.filter("o_orderkey % 3 = 0 AND year >= 1997").withColumn("price", -c("price"))
    for _ in range(2):
        C.upsert(t.spark, orders, changed, ["o_orderkey", "year"], "year")
    joined = t.spark.table(orders).join(t.spark.table(customers), "o_custkey")
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return joined.select("o_orderkey", "o_custkey", "price", "c_mktsegment", nth.alias("nth"))


@check("SC17 SK15 SK16", """
SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) < 1996 THEN 'train' WHEN year(o_orderdate) < 1997 THEN 'val' ELSE 'test' END AS split FROM orders
""")
def splits_round_trip(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "splits")
    split = F.when(c("year") < "1996", "train").when(c("year") < "1997", "val").otherwise("test")
    W.write_splits(_years(t).withColumn("split", split), path, ["o_custkey", "absent"], ["o_orderkey"])
    parts = [R.read_splits(t.spark, path, n).withColumn("split", F.lit(n)) for n in ("train", "val", "test")]
    return stack(parts).select("o_orderkey", "o_custkey", "split")


@check("SK19 U03", """
SELECT '1995-12-31' AS train_end, '1996-12-31' AS val_end, 'o_custkey,o_totalprice,o_orderstatus' AS feature_cols, 3 AS n_features,
  COUNT(*) FILTER (year(o_orderdate) < 1996) AS train, COUNT(*) FILTER (year(o_orderdate) = 1996) AS val, COUNT(*) FILTER (year(o_orderdate) > 1996) AS test FROM orders
""")
def feature_metadata_round_trip(t: Tables) -> DataFrame:
    """Feature list, bounds and split sizes, written beside the splits and read back."""
    path = staging_path(t.spark, "metadata")
    rows = temporal_split(t.orders.withColumn("d", c("o_orderdate").cast("date")), "d", "1995-12-31", "1996-12-31")
    W.write_feature_metadata(t.spark, path, ["o_custkey", "o_totalprice"], ["o_orderstatus"], "1995-12-31", "1996-12-31", W.split_counts(rows))
    ddl = "feature_cols array<string>, train_end string, val_end string, split_counts struct<train: bigint, val: bigint, test: bigint>, n_features int"
    return t.spark.read.schema(ddl).json(path).select("train_end", "val_end", F.array_join("feature_cols", ",").alias("feature_cols"), "n_features", "split_counts.*")


@check("I06", "SELECT o_orderkey, o_orderstatus = 'P' AS bad FROM orders")
def arrivals(t: Tables) -> DataFrame:
    """Files that arrive in two goes; each is processed once."""
    root = staging_path(t.spark, "arrivals")
    ddl = "o_orderkey bigint, o_orderstatus string"

    def clean(df: DataFrame) -> DataFrame:
        return df.withColumn("_has_violation", c("o_orderstatus") == "P").withColumn("exec_date", F.lit("2024-01-01"))

    for part in (c("o_orderkey") % 2 == 0, c("o_orderkey") % 2 == 1):
        t.orders.filter(part).select("o_orderkey", "o_orderstatus").write.mode("append").parquet(f"{root}/in")
        stream_silver(file_stream(t.spark, f"{root}/in", ddl), clean, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    got = t.spark.read.schema("o_orderkey bigint, _has_violation boolean, exec_date string").parquet(f"{root}/out")
    return got.select("o_orderkey", c("_has_violation").alias("bad"))


_DELIVERY = "CASE WHEN o_orderkey % 10 < 7 AND year(o_orderdate) < 1998 THEN 0 WHEN o_orderkey % 10 < 9 THEN 1 ELSE 2 END"


@check("I02 I06", f"""
WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderkey, {_DELIVERY} AS delivery FROM orders
  UNION ALL SELECT o_custkey, CAST(o_orderdate AS DATE), o_orderkey, 2 FROM orders WHERE {_DELIVERY} = 0 AND o_orderkey % 4 = 0),
m AS (SELECT delivery, MAX(d) AS newest FROM d GROUP BY 1),
w AS (SELECT d.*, COALESCE(d < (SELECT MAX(newest) FROM m WHERE m.delivery < d.delivery) - 400, FALSE) AS late FROM d),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, d, late ORDER BY delivery, CAST(o_orderkey AS VARCHAR)) AS nth FROM w)
SELECT o_custkey, d, o_orderkey, CASE WHEN late THEN 'late' WHEN nth = 1 THEN 'taken' ELSE 'repeat' END AS outcome FROM r
""")
def stream_of_late_and_repeated_rows(t: Tables) -> DataFrame:
    """Three deliveries, the stream stopped after each: a customer's first order of a day is taken, repeats and late rows are told apart."""
    root = staging_path(t.spark, "late-stream")
    rows = t.orders.select("o_custkey", c("o_orderdate").cast("date").alias("d"), "o_orderkey")
    delivery = F.expr(_DELIVERY.replace("o_orderdate", "d"))
    first = rows.filter(delivery == 0)
    for part in (first, rows.filter(delivery == 1), rows.filter(delivery == 2).unionByName(first.filter("o_orderkey % 4 = 0"))):
        part.write.mode("append").parquet(f"{root}/in")
        stream_once(file_stream(t.spark, f"{root}/in", rows.schema), ["o_custkey"], "d", f"{root}/out", f"{root}/checkpoint", 400).awaitTermination()
    return t.spark.read.schema(rows.schema.add("outcome", "string")).parquet(f"{root}/out").select("o_custkey", "d", "o_orderkey", "outcome")


@check("P27 P28 SC09", "SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, CAST(NULL AS DOUBLE) AS absent FROM orders")
def aligned_features(t: Tables) -> DataFrame:
    from wardmill.operators.shape import align_features, require_columns

    rows = require_columns(t.orders, ["o_orderkey", "o_custkey"]).select("o_orderkey", c("o_custkey").cast("double").alias("o_custkey"))
    aligned, filled = align_features(rows, ["o_custkey", "absent"])
    assert filled == ["absent"]
    return aligned.select("o_orderkey", "o_custkey", c("absent").cast("double").alias("absent"))


