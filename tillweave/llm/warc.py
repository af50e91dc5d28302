"""WARC archives: writing captures, reading records back, assembling transactions.

A capture is three records: a request, a response (or a revisit that refers to the
response with the same payload) and a metadata record. Request and metadata name the
response through WARC-Concurrent-To; the reader joins them again on that identifier and
gives one nested row per capture. Records are built by built-in functions and written by
Spark's own text sink with the record separator as line end, so any store, the commit
protocol and compression are Spark's; files are parsed by Content-Length alone.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise

#: Captures in a file at most.
PER_FILE = 4000
END = "\r\n\r\n"
RECORD = ("record_type string, record_id string, concurrent_to string, target_uri string, refers_to string, "
          "payload_digest string, payload_bytes long, digest_ok boolean, fields map<string,string>, payload binary")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string's bytes, from four runs of 40 bits."""
    digits = F.sha1(data.cast("binary"))
    runs = [F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*runs), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\x01", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(kind: str, name: Column, uri: Column, length: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), name, F.lit("\r\nWARC-Date: 2020-01-01T00:00:00Z\r\n"),
             F.coalesce(F.concat(F.lit("WARC-Target-URI: "), uri, F.lit("\r\n")), F.lit(""))]
    lines += [F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")) for k, v in headers]
    return F.concat(*lines, F.lit("Content-Length: "), length.cast("string"), F.lit(END), block)


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> DataFrame:
    """Each page with payload, digest and length, and ``refers_to`` where it revisits another page.

    Among equal payloads of at least ``least`` bytes the largest id responds and the
    others revisit it. A null payload is empty. Rows that repeat the largest id and its
    payload are responses as well; a null id responds only where no id is given.
    Only digests are grouped; payloads travel once, by id, to meet their decision.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("string").alias("page"), F.col(id_col).alias("id"),
                        F.translate(F.col(url_col).cast("string"), "\r\n", "").alias("uri"), html.alias("payload"))
    slim = rows.select("id", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    largest = slim.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max("id").alias("top"), F.count("*").alias("n")).where("n > 1")
    # on file, so that the join's sides are both dealt for it and a payload with very many copies can be split
    largest = materialise(largest, "payloads")
    decided = slim.join(largest, ["digest", "bytes"]).where(F.col("top").isNotNull() & ~F.col("id").eqNullSafe(F.col("top"))).select(
        "id", "digest", F.col("top").alias("refers_to")).distinct()
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    return rows.alias("r").join(decided.alias("d"), F.col("r.id").eqNullSafe(F.col("d.id")) & (F.col("r.digest") == F.col("d.digest")), "left").select(
        "r.*", "d.refers_to")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0,
               per_file: int = PER_FILE) -> None:
    """Write one capture per row as gzip archives below ``path``."""
    rows = captures(pages, id_col, url_col, html_col, least)
    page, uri = F.coalesce("page", F.lit("")), F.col("uri")
    unique = F.concat_ws("-", F.lit(path), F.spark_partition_id(), F.monotonically_increasing_id())
    rows = rows.withColumn("key", unique)
    main, ask, about = (_uuid(F.lit(k), F.col("key")) for k in ("response", "request", "metadata"))
    revisit = F.col("refers_to").isNotNull()
    head = F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8{END}")
    size = F.length(head)
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    kind = ("Content-Type", F.lit("application/http; msgtype=response"))
    answer = F.when(revisit, _record("revisit", main, uri, size, [
        digest, kind, ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To-Page", F.col("refers_to").cast("string"))], head)).otherwise(
        _record("response", main, uri, size + F.col("bytes"), [digest, kind], F.concat(head, F.col("payload"))))
    query = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(f" HTTP/1.1{END}"))
    request = _record("request", ask, uri, F.octet_length(query), [("WARC-Concurrent-To", main), (
        "Content-Type", F.lit("application/http; msgtype=request"))], query)
    fields = F.concat(F.lit("payload-bytes: "), F.col("bytes").cast("string"), F.coalesce(
        F.concat(F.lit("\r\npage: "), F.col("page")), F.lit("")), F.lit("\r\n"))
    meta = _record("metadata", about, uri, F.octet_length(fields), [("WARC-Concurrent-To", main), (
        "Content-Type", F.lit("application/warc-fields"))], fields)
    rows.select(F.concat_ws(END, request, answer, meta).alias("value")).write.option("lineSep", END).option(
        "compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record; gzip members are read one after another."""
    stream = io.BytesIO(data)
    source = io.BufferedReader(gzip.GzipFile(fileobj=stream)) if data[:2] == b"\x1f\x8b" else stream
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := source.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            headers[name.decode().lower()] = value.strip().decode("utf-8", "replace")
        length = int(headers["content-length"])
        block = source.read(length)
        if len(block) != length:
            raise ValueError("truncated WARC record")
        yield headers, block


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of all archives below ``path``; HTTP heads are taken off, digests recomputed from the payload."""
    def row(headers: dict[str, str], block: bytes) -> tuple:
        kind, body, fields = headers["warc-type"], None, {}
        digest = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
        good = size = None
        if kind == "response":
            body = block.partition(b"\r\n\r\n")[2]
            good, size = base64.b32encode(hashlib.sha1(body).digest()).decode() == digest, len(body)
        elif kind == "metadata":
            fields = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.decode().splitlines()) if k.strip()}
        return (kind, headers.get("warc-record-id"), headers.get("warc-concurrent-to"), headers.get("warc-target-uri"),
                headers.get("warc-refers-to-page"), digest, size, good, list(fields.items()), body if payload else None)

    kinds = [pa.string()] * 6 + [pa.int64(), pa.bool_(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for data in files.column(0):
                rows = []
                for headers, block in parse(data.as_py()):
                    rows.append(row(headers, block))
                    if len(rows) == 1000:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path)
    return files.select("content").mapInArrow(run, RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: response or revisit, with its request and metadata joined by concurrent-to.

    A capture without request or metadata keeps a null there; requests and metadata that
    name no known response fall.
    """
    def side(kind: str) -> DataFrame:
        return records.where(F.col("record_type") == kind).select("concurrent_to", F.struct(
            "record_id", "target_uri", "fields").alias(kind))

    main = records.where(F.col("record_type").isin("response", "revisit")).select("record_id", F.struct(
        "record_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload_bytes", "digest_ok", "payload").alias("response"))
    for kind in ("request", "metadata"):
        other = side(kind)
        main = main.join(other, main["record_id"] == other["concurrent_to"], "left").drop("concurrent_to")
    return main.drop("record_id")
