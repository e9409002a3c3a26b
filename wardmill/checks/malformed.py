"""Files with planted malformed records: good rows and quarantined lines, with reason and line, both equal to a statement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.checks.registry import Tables, check
from wardmill.operators.quality import TooManyBadRows
from wardmill.session import staging_path
from wardmill.sources import checked as K
from wardmill.sources import writers as W
from wardmill.sources.text_formats import FixedField

c = F.col
NAMES = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey"]
_FILE = r"file=(\d+)/"


def _written(rows: DataFrame, path: str, front: list[str]) -> None:
    """``rows``: file, at and value; each file gets the front lines first and is in order."""
    own = rows.select("file", "at", "value")
    if front:
        heads = F.inline(F.array(*[F.struct(F.lit(i - len(front)).cast("bigint").alias("at"), F.lit(x).alias("value")) for i, x in enumerate(front)]))
        own = rows.select("file").distinct().select("file", heads).unionByName(own)
    files = own.repartition("file").sortWithinPartitions("file", "at")
    files.select("file", "value").write.partitionBy("file").text(path)


def _good_and_bad(records: DataFrame, t: Tables, path: str, names: list[str]) -> DataFrame:
    bad = K.bad_lines(records, t.spark, path)
    good = records.filter("NOT _has_violation").select(*names)
    return good.unionByName(bad.withColumn("file", F.regexp_extract("file", _FILE, 1).cast("int")), allowMissingColumns=True)


#: Planted by the key's remainder: 1 a cell less, 2 a cell more, 3 an open quote, 4 a separator inside quotes.
_LINE = """CASE o_orderkey % 50 WHEN 1 THEN concat_ws('|', o_orderkey, o_orderstatus, o_orderpriority)
  WHEN 2 THEN concat_ws('|', o_orderkey, o_orderstatus, o_orderpriority, o_custkey, 'more')
  WHEN 3 THEN concat_ws('|', o_orderkey, o_orderstatus, concat('"', o_orderpriority), o_custkey)
  WHEN 4 THEN concat_ws('|', o_orderkey, o_orderstatus, concat('"', o_orderpriority, '|"'), o_custkey)
  ELSE concat_ws('|', o_orderkey, o_orderstatus, o_orderpriority, o_custkey) END"""
_REASON = "CASE o_orderkey % 50 WHEN 1 THEN 'short' WHEN 2 THEN 'long' WHEN 3 THEN 'quote' END"


def _lines_sql(front: int) -> str:
    return f"""
WITH x AS (SELECT *, {_LINE} AS value, {_REASON} AS reason, CAST(floor(o_orderkey / 20000) AS INTEGER) AS file,
  ROW_NUMBER() OVER (PARTITION BY floor(o_orderkey / 20000) ORDER BY o_orderkey) + {front} AS line FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 50 = 4 THEN o_orderpriority || '|' ELSE o_orderpriority END AS o_orderpriority,
  CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(NULL AS INTEGER) AS file, CAST(NULL AS BIGINT) AS line, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS record
FROM x WHERE reason IS NULL UNION ALL SELECT NULL, NULL, NULL, NULL, file, line, reason, value FROM x WHERE reason IS NOT NULL
"""


def _order_lines(t: Tables) -> DataFrame:
    return t.orders.select(F.floor(c("o_orderkey") / 20000).alias("file"), c("o_orderkey").cast("bigint").alias("at"), F.expr(_LINE).alias("value"))


@check("SC06 SC09", _lines_sql(1))
def delimited_with_malformed_lines(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "bad-delimited")
    _written(_order_lines(t), path, ["|".join(NAMES)])
    return _good_and_bad(K.checked_delimited(t.spark, path, NAMES, "|"), t, path, NAMES)


@check("SC07 SC08", _lines_sql(2).replace(" AS o_orderkey,", ' AS "O_ORDERKEY",', 1).replace("o_orderstatus, CASE WHEN", 'o_orderstatus AS "O_ORDERSTATUS", CASE WHEN', 1)
       .replace("ELSE o_orderpriority END AS o_orderpriority", 'ELSE o_orderpriority END AS "O_ORDERPRIORITY"', 1).replace(" AS o_custkey,", ' AS "O_CUSTKEY",', 1))
def preamble_with_malformed_lines(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "bad-preamble")
    _written(_order_lines(t), path, ["Some notes", "|".join(NAMES)])
    return _good_and_bad(K.checked_csv_with_preamble(t.spark, path, ["O_ORDERKEY"], separator="|"), t, path, [n.upper() for n in NAMES])


@check("SC10 SC11", """
WITH x AS (SELECT *, lpad(CAST(p_partkey AS VARCHAR), 12, ' ') || rpad(p_brand, 10, ' ') AS front, lpad(CAST(p_size AS VARCHAR), 4, ' ') AS size,
  CASE p_partkey % 50 WHEN 1 THEN 'short' WHEN 2 THEN 'long' END AS reason, CAST(floor(p_partkey / 20000) AS INTEGER) AS file,
  ROW_NUMBER() OVER (PARTITION BY floor(p_partkey / 20000) ORDER BY p_partkey) AS line FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS part_key, p_brand AS brand, CAST(p_size AS VARCHAR) AS size, CAST(NULL AS INTEGER) AS file, CAST(NULL AS BIGINT) AS line,
  CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS record FROM x WHERE reason IS NULL
UNION ALL SELECT NULL, NULL, NULL, file, line, reason, front || CASE reason WHEN 'long' THEN size || 'x' ELSE '' END FROM x WHERE reason IS NOT NULL
""")
def fixed_width_with_malformed_lines(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "bad-fixed")
    kind = c("p_partkey") % 50
    size = F.lpad(c("p_size").cast("string"), 4, " ")
    end = F.when(kind == 1, "").when(kind == 2, F.concat(size, F.lit("x"))).otherwise(size)
    line = F.concat(F.lpad(c("p_partkey").cast("string"), 12, " "), F.rpad("p_brand", 10, " "), end)
    _written(t.part.select(F.floor(c("p_partkey") / 20000).alias("file"), c("p_partkey").cast("bigint").alias("at"), line.alias("value")), path, [])
    layout = [FixedField(1, 12, "part_key"), FixedField(13, 10, "brand"), FixedField(23, 4, "size")]
    return _good_and_bad(K.checked_fixed_width(t.spark, path, layout, "UTF-8"), t, path, ["part_key", "brand", "size"])


@check("SC14", """
WITH x AS (SELECT *, CAST(floor(o_orderkey / 1000) AS BIGINT) AS g, CASE o_orderkey % 50 WHEN 1 THEN 'short' WHEN 2 THEN 'long' END AS reason,
  ROW_NUMBER() OVER (PARTITION BY floor(o_orderkey / 1000) ORDER BY o_orderkey) + 1 AS line FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(NULL AS BIGINT) AS line, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS record
  FROM x WHERE reason IS NULL AND g % 7 > 2
UNION ALL SELECT NULL, NULL, line, reason, '["' || o_orderstatus || '"' || CASE reason WHEN 'long' THEN ',"' || o_orderkey || '","more"' ELSE '' END || ']'
  FROM x WHERE reason IS NOT NULL AND g % 7 > 2
UNION ALL SELECT DISTINCT NULL, NULL, 0, CASE WHEN g % 7 = 2 THEN 'no header' ELSE 'unparsable' END,
  CASE g % 7 WHEN 0 THEN '{"error":"limit ' || g || '"}' WHEN 1 THEN '[["o_orderstatus","o_orderkey"],["' || g ELSE '[["other"],["' || g || '"]]' END FROM x WHERE g % 7 <= 2
""")
def json_matrix_with_malformed_rows(t: Tables) -> DataFrame:
    """A payload per group of orders: error objects, truncated payloads, foreign headers, and rows with a cell less or more."""
    path = staging_path(t.spark, "bad-matrix")
    key, kind, g = c("o_orderkey").cast("string"), c("o_orderkey") % 50, F.floor(c("o_orderkey") / 1000)
    cells = F.when(kind == 1, F.array("o_orderstatus")).when(kind == 2, F.array(c("o_orderstatus"), key, F.lit("more"))).otherwise(F.array(c("o_orderstatus"), key))
    grouped = t.orders.groupBy(g.alias("g")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", cells.alias("cells")))).alias("rows"))
    rows = F.concat(F.array(F.array(F.lit("o_orderstatus"), F.lit("o_orderkey"))), c("rows.cells"))
    number = c("g").cast("string")
    value = (F.when(c("g") % 7 == 0, F.concat(F.lit('{"error":"limit '), number, F.lit('"}')))
             .when(c("g") % 7 == 1, F.concat(F.lit('[["o_orderstatus","o_orderkey"],["'), number))
             .when(c("g") % 7 == 2, F.concat(F.lit('[["other"],["'), number, F.lit('"]]'))).otherwise(F.to_json(rows)))
    grouped.select(value.alias("value")).write.text(path)
    read = t.spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"))
    found = K.checked_json_matrix(read, "value", ["o_orderkey", "o_orderstatus"], "path")
    bad = c("_has_violation")
    return found.select("o_orderkey", "o_orderstatus", F.when(bad, c("line")).alias("line"), c("_reason").alias("reason"), F.when(bad, c("_record")).alias("record"))


#: 1 truncated, 2 a text for a number, 3 a field that the schema lacks, 4 a field less, 5 an array of two records, 6 no object, 7 a JSON null.
_RECORD = """CASE o_orderkey % 50 WHEN 1 THEN concat('{"o_custkey":', o_custkey) WHEN 2 THEN concat('{"o_custkey":"abc","o_orderkey":', o_orderkey, '}')
  WHEN 3 THEN concat('{"extra":[1,2],"o_custkey":', o_custkey, ',"o_orderkey":', o_orderkey, ',"o_orderstatus":"', o_orderstatus, '"}')
  WHEN 4 THEN concat('{"o_orderkey":', o_orderkey, '}')
  WHEN 5 THEN concat('[{"o_custkey":', o_custkey, ',"o_orderkey":', o_orderkey, '},{"o_orderkey":-', o_orderkey, ',"note":"x"}]')
  WHEN 6 THEN concat('', o_orderkey) WHEN 7 THEN concat('{"o_custkey":null,"o_orderkey":', o_orderkey, ',"o_orderstatus":7}')
  ELSE concat('{"o_custkey":', o_custkey, ',"o_orderkey":"', o_orderkey, '","o_orderstatus":"', o_orderstatus, '"}') END"""
_RECORDS_SQL = f"""
WITH l AS (SELECT {_RECORD} AS value FROM orders),
r AS (SELECT value, CASE WHEN NOT json_valid(value) THEN NULL ELSE unnest(CASE WHEN json_type(CASE WHEN json_valid(value) THEN value ELSE '0' END) = 'ARRAY'
  THEN json_extract(value, '$[*]') ELSE [CAST(CASE WHEN json_valid(value) THEN value ELSE 'null' END AS JSON)] END) END AS rec FROM l),
j AS (SELECT value, rec, CASE WHEN NOT json_valid(value) THEN 'unparsable' WHEN json_type(rec) <> 'OBJECT' THEN 'not an object'
    WHEN rec->>'$.o_custkey' IS NOT NULL AND TRY_CAST(rec->>'$.o_custkey' AS BIGINT) IS NULL THEN 'type:o_custkey' END AS reason FROM r)
"""


def _json_lines(t: Tables) -> str:
    path = staging_path(t.spark, "bad-records")
    t.orders.select(F.expr(_RECORD).alias("value")).write.text(path)
    return path


RECORD_DDL = "o_orderkey bigint, o_orderstatus string, o_custkey bigint"


@check("SC15 P06", f"""{_RECORDS_SQL}
SELECT CASE WHEN reason IS NULL THEN CAST(rec->>'$.o_orderkey' AS BIGINT) END AS o_orderkey, CASE WHEN reason IS NULL THEN rec->>'$.o_orderstatus' END AS o_orderstatus,
  CASE WHEN reason IS NULL THEN CAST(rec->>'$.o_custkey' AS BIGINT) END AS o_custkey, reason, CASE WHEN reason IS NOT NULL THEN value END AS record FROM j
""")
def json_records_of_differing_shapes(t: Tables) -> DataFrame:
    """Parsed once as VARIANT; no pass infers a schema."""
    found = K.checked_json_records(t.spark, _json_lines(t), RECORD_DDL)
    return found.select("o_orderkey", "o_orderstatus", "o_custkey", c("_reason").alias("reason"), F.when(c("_has_violation"), c("_record")).alias("record"))


@check("SC15", f"""{_RECORDS_SQL}
SELECT field, COUNT(*) AS n FROM (SELECT unnest(json_keys(rec)) AS field FROM j WHERE json_type(rec) = 'OBJECT') k
WHERE field NOT IN ('o_orderkey', 'o_orderstatus', 'o_custkey') GROUP BY 1
""")
def unseen_json_fields(t: Tables) -> DataFrame:
    return K.unseen_fields(K.json_records(t.spark, _json_lines(t)), RECORD_DDL)


@check("Q06 SK03 A12", """
SELECT COUNT(*) AS total, COUNT(*) FILTER (o_orderpriority < '3') AS bad, CAST(COUNT(*) FILTER (o_orderpriority < '3') AS DOUBLE) / COUNT(*) > CAST(0.2 AS DOUBLE) AS stopped,
  COUNT(*) FILTER (o_orderkey % 20 <> 0) AS rows_left, COUNT(*) FILTER (o_orderkey % 20 = 0) AS quarantine_left FROM orders
""")
def gate_over_limit(t: Tables) -> DataFrame:
    """A batch with a few bad rows is written; one with too many for the same date is stopped and leaves it as it was."""
    base = staging_path(t.spark, "gate")
    rows = t.orders.select("o_orderkey")
    W.write_split(t.orders.select("o_orderkey", (c("o_orderkey") % 20 == 0).alias("_has_violation")), base, "orders", "2024-01-01", max_bad_rate=0.2)
    total, bad, stopped = 0, 0, False
    try:
        counts = W.write_split(t.orders.select("o_orderkey", (c("o_orderpriority") < "3").alias("_has_violation")), base, "orders", "2024-01-01", max_bad_rate=0.2)
        total, bad = counts.total_rows, counts.quarantine_rows
    except TooManyBadRows as e:
        total, bad, stopped = e.total, e.bad, True
    left = t.spark.read.schema("o_orderkey bigint, route string, exec_date string").parquet(f"{base}/orders").join(rows, ["o_orderkey"], "left_semi")
    return left.agg(F.count_if(c("route") == "silver").alias("rows_left"), F.count_if(c("route") == "quarantine").alias("quarantine_left")).select(
        F.lit(total).cast("bigint").alias("total"), F.lit(bad).cast("bigint").alias("bad"), F.lit(stopped).alias("stopped"), "rows_left", "quarantine_left")
