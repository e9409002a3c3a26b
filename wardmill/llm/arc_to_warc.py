"""Legacy web archives: ARC records become WARC records.

An ARC record is a header line and as many bytes as the line's last field declares. Version 1 lines have five fields: url,
address, date, media type, length. Version 2 lines have ten: status, checksum, location, offset and file name stand before
the length. ``parsed`` reads records by declared length, ``converted`` makes WARC identifiers, dates, types and digests,
``with_revisits`` replaces equal payloads by references, ``write_warc`` writes gzip archives with Spark's text writer (a
record a row, its end mark as separator: all bytes are kept) and ``read_warc`` reads archives by declared length, a record
at a time. Payloads stay in the JVM until archives are read.

Identifiers are derived from what a record holds, so that a rerun gives the same archives.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.llm.shared import new_path

CRLF = "\r\n"
END = CRLF + CRLF
#: A smaller payload is never replaced by a reference.
LEAST_BYTES = 100
VOLUME_RECORDS = 5_000
#: Identifiers of the WARC 1.1 format.
WARC = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- ARC ------------------------------------------------------------------------------------------------------------


def rendered_arc(pages: DataFrame, *, id_: str = "page_id", url: str = "url", page: str = "html", address: str = "0.0.0.0", date: str = "20240101000000") -> DataFrame:
    """``key``, ``version`` (1 or 2, by the id), ``record``: pages as a crawler of old stored them, HTTP response included."""
    body = F.coalesce(F.encode(F.col(page), "UTF-8"), F.lit(b""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(body).cast("string"), F.lit(END))
    block = F.concat(F.encode(head, "UTF-8"), body)
    place = F.coalesce(F.regexp_replace(F.trim(url), r"\s", "%20"), F.concat(F.lit("urn:page:"), F.coalesce(F.col(id_).cast("string"), F.lit(""))))
    version = F.when(F.col(id_) % 2 == 0, 1).otherwise(2)
    length = F.octet_length(block).cast("string")
    first = F.concat_ws(" ", place, F.lit(address), F.lit(date), F.lit("text/html"))
    line = F.when(version == 1, F.concat_ws(" ", first, length)).otherwise(F.concat_ws(" ", first, F.lit("200 - - 0 pages.arc"), length))
    return pages.select(F.col(id_).alias("key"), version.alias("version"), F.concat(F.encode(F.concat(line, F.lit("\n")), "UTF-8"), block).alias("record"))


def arc_records(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, version and bytes (header line and declared length) of each record of an ARC file, plain or gzip."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content))
    version, at = 1, 0
    while line := stream.readline():
        size = len(line)
        fields = line.split()
        if fields and fields[-1].isdigit():
            block = stream.read(int(fields[-1]))
            size += len(block)
            if line.startswith(b"filedesc:"):                # its block starts with the version: "2 0 Origin"
                version = 2 if block.split(None, 1)[:1] == [b"2"] else 1
            yield at, version, line + block
        at += size


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """``key`` (file and offset), ``version``, ``record`` of ARC files. Lines that are no header are passed over."""

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for at, version, record in arc_records(content.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([f"{name}#{at}"]), pa.array([version], pa.int32()), pa.array([record])], names=["key", "version", "record"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "key string, version int, record binary")


def parsed(records: DataFrame) -> DataFrame:
    """Fields of ``key``, ``version``, ``record``: url, address, date, media_type, declared, head (HTTP), payload, complete.

    ``complete`` is false where the line is broken or fewer bytes follow than it declares; what there is, is kept.
    """
    text = F.col("record").cast("string")
    line = F.substring_index(text, "\n", 1)
    fields = F.split(F.rtrim(line), " ")
    declared = F.try_element_at(fields, F.lit(-1)).try_cast("int")
    rows = records.select("key", "version", "record", F.octet_length(line).alias("skip"), fields.alias("fields"), F.greatest(F.coalesce(declared, F.lit(0)), F.lit(0)).alias("declared"),
                          (declared.isNotNull() & (F.size(fields) == F.when(F.col("version") == 1, 5).otherwise(10))).alias("sound"))
    rows = rows.withColumn("block", F.substring(F.col("record"), F.col("skip") + 2, F.col("declared")))
    is_http = F.substring(F.col("block"), 1, 5) == F.lit(b"HTTP/")
    rows = rows.withColumn("head", F.when(is_http, F.substring_index(F.col("block").cast("string"), END, 1)))
    part = lambda i: F.try_element_at("fields", F.lit(i))
    return rows.select(
        "key", part(1).alias("url"), part(2).alias("address"), part(3).alias("date"), part(4).alias("media_type"), "declared", "head",
        F.when(is_http, F.substring(F.col("block"), F.octet_length("head") + 1 + len(END), F.col("declared"))).otherwise(F.col("block")).alias("payload"),
        (F.col("sound") & (F.octet_length("block") == F.col("declared"))).alias("complete"))


# --- WARC -----------------------------------------------------------------------------------------------------------


def _identifier(seed: Column) -> Column:
    h = F.sha1(seed)
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-5"), cut(14, 3), F.lit("-a"), cut(18, 3), F.lit("-"), cut(21, 12), F.lit(">"))


def _date(digits: Column) -> Column:
    """Of 14, 12 or 8 digits; the first second of 1970 where there is no date."""
    exact = F.coalesce(*[F.when(F.length(digits) >= n, F.try_to_timestamp(F.substring(digits, 1, n), F.lit(p))) for p, n in (("yyyyMMddHHmmss", 14), ("yyyyMMddHHmm", 12), ("yyyyMMdd", 8))],
                       F.to_timestamp(F.lit("1970-01-01 00:00:00")))
    return F.date_format(exact, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def converted(arc: DataFrame) -> DataFrame:
    """WARC fields of parsed ARC records: key, record_id, warc_date, uri, warc_type, media_type, address, head, payload, payload_bytes, payload_digest.

    A file description becomes warcinfo, an HTTP response response, anything else (DNS answers, FTP files) resource.
    """
    digest = F.sha2(F.col("payload"), 256)
    kind = F.when(F.startswith("url", F.lit("filedesc:")), "warcinfo").when(F.col("head").isNotNull(), "response").otherwise("resource")
    rows = arc.select("key", "address", "head", "payload", F.coalesce("url", F.lit("")).alias("uri"), _date(F.col("date")).alias("warc_date"), kind.alias("warc_type"),
                      F.coalesce("media_type", F.lit("application/octet-stream")).alias("media_type"),
                      F.octet_length("payload").cast("long").alias("payload_bytes"), digest.alias("payload_digest"))
    return rows.withColumn("record_id", _identifier(F.concat_ws("|", F.coalesce(F.col("key").cast("string"), F.lit("")), "uri", "warc_date", "payload_digest")))


def with_revisits(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Adds ``refers_key`` and ``refers_to`` (key and id of the response with the same payload and the smallest key) to responses that repeat one.

    The table of repeated payloads is aggregated before it moves; the join is on the digest, and a payload that a large part
    of all records share is a hot key on one side only, which adaptive execution splits.
    """
    usable = (F.col("warc_type") == "response") & (F.col("payload_bytes") >= least_bytes)
    first = records.where(usable).groupBy("payload_digest").agg(F.min(F.when(F.col("key").isNotNull(), F.struct("key", "record_id"))).alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1 and first is not null").select(F.col("payload_digest").alias("same"), F.col("first.key").alias("first_key"), F.col("first.record_id").alias("first_id"))
    joined = records.withColumn("same", F.when(usable, F.col("payload_digest")).otherwise(F.col("record_id"))).join(first, "same", "left")
    again = F.col("first_key").isNotNull() & ~F.col("first_key").eqNullSafe(F.col("key"))
    return joined.withColumns({"refers_key": F.when(again, F.col("first_key")), "refers_to": F.when(again, F.col("first_id"))}).drop("same", "first_key", "first_id")


def warc_records(records: DataFrame) -> DataFrame:
    """``record``: the bytes of each WARC record without its end mark."""
    revisit = F.col("refers_to").isNotNull()
    head = F.when(F.col("head").isNotNull(), F.concat(F.col("head").cast("binary"), F.lit(END.encode()))).otherwise(F.lit(b""))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    kind = F.when(revisit, "revisit").otherwise(F.col("warc_type"))
    media = F.when(F.col("head").isNotNull(), "application/http;msgtype=response").otherwise(F.col("media_type"))
    known = ~F.coalesce("address", F.lit("")).isin("", "-", "0.0.0.0")
    line = lambda name, value, there=None: (F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) if there is None
                                            else F.when(there, F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise(""))
    lines = F.concat(
        F.lit(WARC + CRLF), line("WARC-Type", kind), line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("warc_date")),
        line("WARC-Target-URI", F.col("uri"), F.col("warc_type") != "warcinfo"), line("WARC-IP-Address", F.coalesce("address", F.lit("")), known),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")), line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(block, 256))),
        line("WARC-Profile", F.lit(PROFILE), revisit), line("WARC-Refers-To", F.coalesce("refers_to", F.lit("")), revisit),
        line("X-Refers-To-Key", F.coalesce(F.col("refers_key").cast("string"), F.lit("")), revisit),
        line("X-Source-Key", F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("key").isNotNull()), line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("Content-Type", media), line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF))
    return records.select(F.concat(F.encode(lines, "UTF-8"), block).alias("record"))


def write_warc(records: DataFrame, path: str, volume_records: int = VOLUME_RECORDS) -> None:
    """Archives of at most ``volume_records`` records each."""
    lines = warc_records(records).select(F.col("record").cast("string"))
    lines.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", volume_records).text(path)


def warc_stream(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a WARC file, plain or gzip, by declared length."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content))
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"record {fields.get('warc-record-id')} ends early")
        yield fields, block


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """``key``, ``record_type``, ``record_id``, ``uri``, ``warc_date``, ``refers_key``, ``refers_to``, ``payload_bytes``, ``payload_digest``, and ``payload`` on request.

    Size and digest of a response are taken from the bytes that were read, and must match its header; a revisit has its header's.
    """
    names = ["key", "record_type", "record_id", "uri", "warc_date", "refers_key", "refers_to", "payload_bytes", "payload_digest", "payload"]

    def one(fields: dict[str, str], block: bytes) -> tuple:
        stated = fields.get("warc-payload-digest", "").removeprefix("sha256:")
        size = int(fields.get("x-payload-length", 0))
        payload = None
        if fields["warc-type"] != "revisit":
            is_http = fields.get("content-type", "").startswith("application/http")
            payload = block.partition(END.encode())[2] if is_http else block
            found = hashlib.sha256(payload).hexdigest()
            if stated and found != stated:
                raise ValueError(f"record {fields.get('warc-record-id')} has another payload than its digest says")
            stated, size = found, len(payload)
        return (fields.get("x-source-key"), fields["warc-type"], fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date"),
                fields.get("x-refers-to-key"), fields.get("warc-refers-to"), size, stated, payload if payloads else None)

    def run(batches):
        schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string()) for n in names])
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in warc_stream(content.as_py()):
                    rows.append(one(fields, block))
                    held += len(block) if payloads else 0
                    if len(rows) >= 1000 or held > 1 << 23:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    types = ", ".join(f"{n} {'long' if n == 'payload_bytes' else 'binary' if n == 'payload' else 'string'}" for n in names)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, types)


def pages_through_archives(pages: DataFrame, *, id_: str = "page_id", url: str = "url", page: str = "html", least_bytes: int = LEAST_BYTES, path: str | None = None) -> DataFrame:
    """Pages rendered as ARC records, converted, written as WARC archives to ``path`` (else the shared folder) and read back."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    records = converted(parsed(rendered_arc(pages, id_=id_, url=url, page=page)))
    write_warc(with_revisits(records, least_bytes), path)
    return read_warc(spark, path)
