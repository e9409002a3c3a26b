"""Delimited, fixed-width and JSON payload files.

Only layouts (headers, field positions) reach the driver; their size is that of
a schema, and it is checked. Data lines are parsed where they are read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardmill.operators.shape import unique_names

#: Header lines, layout lines or column names that may come to the driver.
MAX_LAYOUT_ROWS = 20_000


def read_delimited(
    spark: SparkSession, path: str | list[str], separator: str = ",", encoding: str = "UTF-8",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Every column as text; a byte-order mark and blanks around header names are dropped."""
    df = spark.read.csv(path, sep=separator, header=True, encoding=encoding, inferSchema=False)
    df = df.toDF(*[n.lstrip("﻿").strip() for n in df.columns])
    return df.select(*columns) if columns else df


def header_names(line: str, repeated: Mapping[str, Sequence[str]], separator: str = ",") -> list[str]:
    """Upper-case names with ``_`` for blanks.

    ``repeated`` names the occurrences of a column that may appear several
    times; a single occurrence gets the last of its names.
    """
    names = [n.strip().strip('"').upper() for n in line.lstrip("﻿").split(separator)]
    for name, replacements in repeated.items():
        at = [i for i, n in enumerate(names) if n == name.upper()]
        for i, new in zip(at, replacements[-len(at):] if at else []):
            names[i] = new
    return [n.replace(" ", "_") for n in names]


def has_cell(tokens: Sequence[str], separator: str = ",") -> Callable[[Column], Column]:
    """Header test: one of the line's cells begins with one of the tokens, whatever the number of cells."""
    def test(line: Column) -> Column:
        cells = F.transform(F.split(F.upper(line), f"\\Q{separator}\\E"), lambda x: F.trim(F.translate(x, '"\ufeff', "")))
        return F.size(cells).__gt__(1) & F.exists(cells, lambda x: F.array_max(F.array(*[F.startswith(x, F.lit(t.upper())) for t in tokens])))

    return test


def read_csv_with_preamble(
    spark: SparkSession, path: str | list[str], header_tokens: Sequence[str],
    repeated: Mapping[str, Sequence[str]] | None = None, separator: str = ",",
    is_header: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """CSV files that start with free text: rows after each file's first header line, all text.

    ``is_header`` tells a header line; by default one of its cells begins with
    one of the tokens. A file without one is an error. A line's place in its
    file is (block start, running id inside the scan), so files may be split and
    read in parallel. The headers, one line a file, are collected and attached
    as a broadcast table of that many rows; the data is scanned once more and
    never shuffled. Each line is cut by position and named by its own file's
    header; columns that a file lacks are NULL.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
        ).alias("_at"),
    )
    found = lines.withColumn("_is_header", (is_header or has_cell(header_tokens, separator))(F.col("value")))
    headers = found.groupBy("_file").agg(
        F.min_by("value", F.when(F.col("_is_header"), F.col("_at"))).alias("header"),
        F.min(F.when(F.col("_is_header"), F.col("_at"))).alias("at"),
    ).limit(MAX_LAYOUT_ROWS + 1).collect()
    if len(headers) > MAX_LAYOUT_ROWS:
        raise ValueError(f"more than {MAX_LAYOUT_ROWS} files at once; read them in parts")
    without = sorted(r["_file"] for r in headers if r["at"] is None)
    if without or not headers:
        raise ValueError(f"no header line with any of {list(header_tokens)} in {without or path}")
    layouts = sorted({r["header"] for r in headers})
    names = [unique_names(header_names(h, repeated or {}, separator)) for h in layouts]
    columns = list(dict.fromkeys(n for own in names for n in own))
    places = [[own.index(n) if n in own else -1 for n in columns] for own in names]
    of_file = spark.createDataFrame(
        [(r["_file"], r["at"]["block"], r["at"]["line"], places[layouts.index(r["header"])]) for r in headers],
        "_file string, _block bigint, _line bigint, _places array<int>",
    )
    widest = max(len(own) for own in names)
    cells = F.from_csv("value", ", ".join(f"c{i} string" for i in range(widest)), {"sep": separator})
    body = lines.join(F.broadcast(of_file), "_file").filter(
        (F.col("_at") > F.struct(F.col("_block").alias("block"), F.col("_line").alias("line"))) & (F.trim("value") != "")
    ).withColumn("_r", cells)
    row = body.select(F.array(*[F.col(f"_r.c{i}") for i in range(widest)]).alias("_cells"), "_places")
    return row.select(*[
        F.when(F.col("_places")[i] >= 0, F.get("_cells", F.col("_places")[i])).alias(n) for i, n in enumerate(columns)
    ])


@dataclass(frozen=True)
class FixedField:
    start: int
    width: int
    name: str


def layout_field(line: str) -> FixedField | None:
    """One field line, ``@start name [$] width. /*label*/``, or None for any other line.

    The name is the label's words joined by ``_``, without characters other than
    letters, digits and ``_``.
    """
    _, mark, rest = line.partition("@")
    numbers, opened, comment = rest.partition("/*")
    label, closed, _ = comment.partition("*/")
    fields = numbers.replace("$", " ").split()
    if not (mark and opened and closed) or len(fields) != 3:
        return None
    start, _, width = fields
    if not (start.isdecimal() and width.endswith(".") and width[:-1].isdecimal()):
        return None
    plain = ["".join(x for x in word if x.isascii() and (x.isalnum() or x == "_")) for word in label.split()]
    return FixedField(int(start), int(width[:-1]), "_".join(plain))


def parse_layout(lines: Sequence[str]) -> list[FixedField]:
    """Fields of a layout file by position; repeated labels are numbered."""
    fields = sorted((f for f in map(layout_field, lines) if f is not None), key=lambda f: f.start)
    return [FixedField(f.start, f.width, name) for f, name in zip(fields, unique_names([f.name for f in fields]), strict=True)]


def read_layout(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> list[FixedField]:
    """A layout describes one schema, so its field lines, as many as columns, are parsed on the driver."""
    lines = (
        spark.read.csv(path, sep="\u0001", quote="", encoding=encoding, schema="value string")
        .filter(F.contains("value", F.lit("@"))).limit(MAX_LAYOUT_ROWS + 1).collect()
    )
    if len(lines) > MAX_LAYOUT_ROWS:
        raise ValueError(f"{path} has more than {MAX_LAYOUT_ROWS} field lines")
    return parse_layout([r["value"] for r in lines])


def read_fixed_width(
    spark: SparkSession, path: str | list[str], layout: Sequence[FixedField], encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Fields cut by position and trimmed; blank fields are NULL."""
    lines = spark.read.csv(
        path, sep="\u0001", quote="", encoding=encoding, schema="value string",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return lines.select(*[
        F.nullif(F.trim(F.substring("value", f.start, f.width)), F.lit("")).alias(f.name) for f in layout
    ])


def rows_from_json_matrix(df: DataFrame, column: str, names: Sequence[str] | None = None) -> DataFrame:
    """Payloads of the form ``[[header...], [row...], ...]`` to rows of text columns.

    Each payload is read by its own header: a cell belongs to the name above it,
    wherever that stands. A name that occurs again in ``names`` means its next
    occurrence in the header. Without ``names`` all headers' names are taken.
    """
    matrix = F.from_json(F.col(column), "array<array<string>>")
    rows = df.select(matrix.alias("_matrix")).filter(F.size("_matrix") > 0)
    header = F.element_at("_matrix", 1)
    if names is None:
        # A name's k-th occurrence in one header, in the order in which headers list them.
        one = rows.select(F.posexplode(header).alias("at", "name"), header.alias("header"))
        before = F.size(F.filter(F.slice("header", 1, F.col("at") + 1), lambda x: x == F.col("name")))
        listed = one.groupBy("name", before.alias("k")).agg(F.min("at").alias("at")).limit(MAX_LAYOUT_ROWS + 1).collect()
        if len(listed) > MAX_LAYOUT_ROWS:
            raise ValueError(f"the payloads have more than {MAX_LAYOUT_ROWS} column names")
        if not listed:
            raise ValueError("no payload holds a header row")
        names = [r["name"] for r in sorted(listed, key=lambda r: (r["at"], r["name"] or "", r["k"]))]
    seen: dict[str, int] = {}
    places = []
    for n in names:
        name = F.lit(n)
        at = F.array_compact(F.transform("_header", lambda x, i: F.when(x == name, i)))  # noqa: B023  called at once
        places.append(F.get(at, seen.get(n, 0)))
        seen[n] = seen.get(n, 0) + 1
    placed = rows.withColumn("_header", header).withColumn("_places", F.array(*places))
    cells = placed.select("_places", F.explode(F.slice("_matrix", F.lit(2), F.greatest(F.size("_matrix") - 1, F.lit(0)))).alias("cells"))
    return cells.select(*[
        F.get(F.col("cells"), F.col("_places")[i]).alias(n) for i, n in enumerate(unique_names(names))
    ])


def read_json_records(
    spark: SparkSession, path: str | list[str], schema: str | StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Records with every value as text; a given schema avoids the inference pass.

    A line holds a record or an array of them, so large files are split. ``multi_line`` is for values that span lines;
    each such file is then one task's.
    """
    reader = spark.read.option("multiLine", multi_line).option("primitivesAsString", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)
