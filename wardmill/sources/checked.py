"""Readers that tell malformed records from good ones, with file and line, in the same scan.

Each returns all records with the wanted columns and ``_record`` (the text as it came), ``_reason`` (null for a good record),
``_has_violation``, and where it stood. ``sources.writers`` routes them in one pass; ``located`` turns a record's place in
the scan into its line. Nothing is dropped: every line of the input, headers and blank lines aside, is one record of the result.

Reasons: ``quote`` (a quote that is not closed on its line; records do not span lines), ``short`` and ``long`` (fewer or more cells,
or characters, than the layout has), ``unparsable`` (no JSON), ``not an object``, ``no header``, ``type:`` and the field's name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from wardmill.operators.shape import unique_names
from wardmill.schemas import struct
from wardmill.session import staging_path
from wardmill.sources.text_formats import MAX_LAYOUT_ROWS, FixedField, has_cell, header_names

#: Columns that say where a record stood in the scan, and what is wrong with it.
PLACE = ("_file", "_block", "_at")
CHECK = ("_record", "_reason", "_has_violation")


def scanned_lines(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """``value`` and a line's place: file, block and running number inside the scan. Files may be split and read in parallel."""
    lines = spark.read.text(path)
    value = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return lines.select(
        value.alias("value"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )


def located(records: DataFrame, spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Adds ``line`` (from 1) to records of a scan of ``path``, usually the few that are bad.

    Lines are counted once for each block of a file; the blocks before a record's own and its number in that block give its line.
    """
    blocks = scanned_lines(spark, path).groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("_file").orderBy("_block")) - F.col("_n")
    starts = blocks.select("_file", "_block", "_first", before.alias("_before"))
    found = records.join(starts, ["_file", "_block"])
    return found.withColumn("line", F.col("_at") - F.col("_first") + F.col("_before") + 1).drop("_first", "_before")


def bad_lines(records: DataFrame, spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file``, ``line``, ``reason`` and ``record`` of the bad records."""
    return located(records.filter("_has_violation"), spark, path).select(
        F.col("_file").alias("file"), "line", F.col("_reason").alias("reason"), F.col("_record").alias("record"))


def _judged(df: DataFrame, columns: Mapping[str, Column], reason: Column, record: Column, *more: str) -> DataFrame:
    wanted = df.withColumns({"_record_": record, "_reason_": reason})
    good = F.col("_reason_").isNull()
    return wanted.select(
        *[F.when(good, c).alias(n) for n, c in columns.items()], F.col("_record_").alias("_record"), F.col("_reason_").alias("_reason"),
        (~good).alias("_has_violation"), *more,
    )


def _cells(line: Column, separator: str) -> Column:
    """Number of cells: separators outside of quotes, and one."""
    unquoted = F.regexp_replace(line, '"[^"]*"', "")
    return F.size(F.split(unquoted, f"\\Q{separator}\\E"))


def _delimited_reason(line: Column, separator: str, width: Column) -> Column:
    open_quote = (F.length(line) - F.length(F.translate(line, '"', ""))) % 2 == 1
    n = _cells(line, separator)
    return F.when(open_quote, "quote").when(n < width, "short").when(n > width, "long")


def _delimited_cells(n: int, separator: str) -> Column:
    return F.from_csv("value", ", ".join(f"c{i} string" for i in range(n)), {"sep": separator, "escape": '"'})


def checked_delimited(spark: SparkSession, path: str | list[str], columns: Sequence[str], separator: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Delimited text whose files start with a header line of exactly these columns; all values text."""
    lines = scanned_lines(spark, path, encoding)
    bare = F.translate(F.col("value"), '"﻿\r ', "")
    is_header = bare == F.lit(separator.join(columns).replace(" ", "").replace('"', ""))
    body = lines.filter(~is_header & (F.trim("value") != ""))
    row = body.withColumn("_r", _delimited_cells(len(columns), separator))
    values = {n: F.col(f"_r.c{i}") for i, n in enumerate(columns)}
    return _judged(row, values, _delimited_reason(F.col("value"), separator, F.lit(len(columns))), F.col("value"), *PLACE)


def checked_fixed_width(spark: SparkSession, path: str | list[str], layout: Sequence[FixedField], encoding: str = "ISO-8859-1", padded: bool = True) -> DataFrame:
    """Fields cut by position. A line ends where the last field does; blanks after it do no harm, nor missing ones if not ``padded``."""
    end = max(f.start + f.width - 1 for f in layout)
    begins = max(f.start for f in layout)
    lines = scanned_lines(spark, path, encoding).filter(F.trim("value") != "")
    line = F.col("value")
    reason = F.when(F.length(line) < (end if padded else begins), "short").when(F.trim(F.substring(line, end + 1, 1 << 30)) != "", "long")
    values = {f.name: F.nullif(F.trim(F.substring(line, f.start, f.width)), F.lit("")) for f in layout}
    return _judged(lines, values, reason, line, *PLACE)


def checked_csv_with_preamble(
    spark: SparkSession, path: str | list[str], header_tokens: Sequence[str], repeated: Mapping[str, Sequence[str]] | None = None, separator: str = ",",
) -> DataFrame:
    """CSV files that start with free text; each is read by its own first header line, and files may be any number.

    One row for each file is stored and joined by measured size; only the distinct headers, which describe schemas, reach the driver.
    A file without a header line is an error.
    """
    lines = scanned_lines(spark, path)
    place = F.struct("_block", "_at")
    tested = lines.withColumn("_is_header", has_cell(header_tokens, separator)(F.col("value")))
    heads = tested.groupBy("_file").agg(F.min(F.when(F.col("_is_header"), F.struct(place.alias("place"), F.col("value").alias("header")))).alias("_head"))
    stored = staging_path(spark, "headers")
    heads.write.parquet(stored)
    heads = spark.read.schema(heads.schema).parquet(stored)
    without = [r["_file"] for r in heads.filter("_head IS NULL").limit(5).collect()]
    if without:
        raise ValueError(f"no header line with any of {list(header_tokens)} in {without}")
    layouts = sorted(r[0] for r in heads.select("_head.header").distinct().limit(MAX_LAYOUT_ROWS + 1).collect())
    if not layouts or len(layouts) > MAX_LAYOUT_ROWS:
        raise ValueError(f"{len(layouts)} different header lines in {path}")
    names = [unique_names(header_names(h, repeated or {}, separator)) for h in layouts]
    columns = list(dict.fromkeys(n for own in names for n in own))
    places = spark.createDataFrame(
        [(h, [own.index(n) if n in own else -1 for n in columns], len(own)) for h, own in zip(layouts, names, strict=True)],
        "_header string, _places array<int>, _width int")
    of_file = heads.select("_file", F.col("_head.place").alias("_start"), F.col("_head.header").alias("_header")).join(F.broadcast(places), "_header")
    body = lines.join(of_file, "_file").filter((place > F.col("_start")) & (F.trim("value") != ""))
    widest = max(len(own) for own in names)
    row = body.withColumn("_r", _delimited_cells(widest, separator)).withColumn("_all", F.array(*[F.col(f"_r.c{i}") for i in range(widest)]))
    values = {n: F.when(F.col("_places")[i] >= 0, F.get("_all", F.col("_places")[i])) for i, n in enumerate(columns)}
    return _judged(row, values, _delimited_reason(F.col("value"), separator, F.col("_width")), F.col("value"), *PLACE)


def checked_json_matrix(df: DataFrame, column: str, names: Sequence[str], file: str) -> DataFrame:
    """Payloads ``[[header...], [row...], ...]``, each read by its own header. ``line`` counts the payload's rows, the header included.

    A payload that is no such JSON, or has no header with all the names, is one bad record of line 0 and the whole text.
    """
    matrix = F.from_json(F.col(column), "array<array<string>>")
    read = df.select(F.col(file).alias("_file"), F.col(column).alias("_text"), matrix.alias("_matrix"))
    header = F.get("_matrix", 0)
    places = F.array(*[F.array_position(header, n).cast("int") for n in names])
    whole = F.when(F.col("_matrix").isNull(), "unparsable").when(F.coalesce(F.array_min(places), F.lit(0)) < 1, "no header")
    read = read.withColumns({"_whole": whole, "_places": places, "_width": F.size(header)})
    rows = F.when(F.col("_whole").isNull(), F.slice("_matrix", F.lit(2), F.greatest(F.size("_matrix") - 1, F.lit(0)))).otherwise(F.array(F.lit(None).cast("array<string>")))
    each = read.select("_file", "_text", "_whole", "_places", "_width", F.posexplode(rows).alias("_i", "_cells"))
    n = F.coalesce(F.size("_cells"), F.lit(0))
    reason = F.coalesce(F.col("_whole"), F.when(F.col("_cells").isNull() | (n < F.col("_width")), "short").when(n > F.col("_width"), "long"))
    record = F.when(F.col("_whole").isNull(), F.to_json("_cells")).otherwise(F.col("_text"))
    placed = each.withColumn("line", F.when(F.col("_whole").isNull(), F.col("_i") + 2).otherwise(0).cast("long"))
    return _judged(placed, {n: F.get("_cells", F.col("_places")[i] - 1) for i, n in enumerate(names)}, reason, record, "_file", "line")


def _field(record: Column, name: str, kind: str | DataType) -> Column:
    mark = '"' if "'" in name else "'"
    if mark in name:
        raise ValueError(f"a field's name cannot hold both kinds of quotes: {name}")
    return F.try_variant_get(record, f"$[{mark}{name}{mark}]", kind if isinstance(kind, str) else kind.simpleString())


def json_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines that hold a JSON record or an array of them, as VARIANT: parsed once, in one scan, whatever fields a record has.

    ``record`` is null where the text is no JSON (repeated names in an object included).
    """
    lines = scanned_lines(spark, path).filter(F.trim("value") != "")
    parsed = lines.withColumn("_v", F.expr("try_parse_json(value)"))
    own = F.coalesce(F.try_variant_get("_v", "$", "array<variant>"), F.array("_v"))
    return parsed.select("value", *PLACE, F.explode(own).alias("record"))


def checked_json_records(spark: SparkSession, path: str | list[str], schema: str | StructType) -> DataFrame:
    """Records typed by a schema without an inference pass; fields that the schema lacks are passed over (``unseen_fields`` lists them).

    A value that cannot be cast to its field's type makes the record bad; JSON null and an absent field are NULL. Numbers as text
    have their shortest form.
    """
    fields = struct(schema).fields if isinstance(schema, str) else schema.fields
    rows = json_records(spark, path)
    record = F.col("record")
    typed = {f.name: _field(record, f.name, f.dataType) for f in fields}
    there = lambda f: _field(record, f.name, "variant").isNotNull() & ~F.is_variant_null(_field(record, f.name, "variant"))
    reason = F.when(record.isNull(), "unparsable").when(~F.startswith(F.schema_of_variant(record), F.lit("OBJECT")), "not an object")
    for f in fields:
        reason = reason.when(there(f) & typed[f.name].isNull(), f"type:{f.name}")
    text = F.when(record.isNull(), F.col("value")).otherwise(F.to_json(record))
    return _judged(rows, typed, reason, text, *PLACE)


def unseen_fields(records: DataFrame, schema: str | StructType) -> DataFrame:
    """``field`` and ``n``: names in the records that the schema lacks, and how often; counted map-side."""
    known = [f.name for f in (struct(schema) if isinstance(schema, str) else schema).fields]
    objects = records.filter(F.startswith(F.schema_of_variant("record"), F.lit("OBJECT")))
    names = objects.select(F.explode(F.json_object_keys(F.to_json("record"))).alias("field"))
    return names.filter(~F.col("field").isin(known)).groupBy("field").agg(F.count(F.lit(1)).alias("n"))
