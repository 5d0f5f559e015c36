"""WARC archives with revisit records (operator 6).

``write_archives`` shuffles headers by payload digest, finds the record with
the smallest page id per digest, joins every record to it and writes response
records with their payload and revisit records without, all with fresh
headers.  ``read_archives`` parses the files and joins revisit records, by
digest, to the original responses, which gives them the payload's size back.

Files are written by Spark's own text writer: a record's value is its head
and block, and the line separator is the two line ends that close a WARC
record.  They are gzip files with a bounded number of records each.

Defined cases: a null payload is empty; a null url has no target header; a
null page id never is the smallest (records whose payload has no other id are
all responses); repeated rows of the first record are responses too; payloads
shorter than ``min_bytes`` are always responses; an empty table gives an
empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RECORDS_PER_FILE = 5_000
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_END = "\r\n"


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.upper(F.conv(F.substring(digits, 1 + 10 * g, 10), 16, 32)), 8, "0") for g in range(4)]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


def records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, digest, refers_to); refers_to is null for responses."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": payload_digest(F.col("payload").cast("binary"))})
    first = rows.select("page_id", "digest").groupBy("digest").agg(F.min("page_id").alias("first"))
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    return rows.join(first, "digest").withColumn("refers_to", F.when(revisit, F.col("first"))).drop("first")


def _head(fields: list[tuple[str, Column]]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat_ws("", *[F.concat(F.lit(f"{k}: "), v.cast("string"), F.lit(_END)) for k, v in fields])


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES, date: str = DATE, **columns) -> None:
    rows = records(pages, min_bytes, **columns)
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(_END * 2))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = _head([
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", urn(F.col("page_id"))),
        ("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")),
        ("WARC-Date", F.lit(date)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(revisit, PROFILE)),
        ("WARC-Refers-To", F.when(revisit, urn(F.col("refers_to")))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length(block)),
    ])
    (
        rows.select(F.concat(F.lit(f"WARC/1.1{_END}"), head, F.lit(_END), block).alias("value"))
        .write.option("lineSep", _END * 2).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    )


def _parse(data: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode("utf-8").split(_END)
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        begin = head_end + 4
        end = begin + int(head["Content-Length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut")
        page = re.fullmatch(r"<urn:page:(-?\d*)>", head["WARC-Record-ID"])[1]
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        size = None
        if head["WARC-Type"] == "response":
            payload = data[data.index(b"\r\n\r\n", begin) + 4:end]
            size = len(payload)
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"the payload at byte {at} does not have its digest")
        refers = head.get("WARC-Refers-To")
        yield (int(page) if page else None, head.get("WARC-Target-URI"), head["WARC-Type"], digest, size, int(refers[len("<urn:page:"):-1]) if refers else None)
        at = end + 4


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record in the files; payload_bytes is null for revisits."""
    schema = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                frame = pd.DataFrame(list(_parse(zlib.decompress(content, 31))), columns=["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to"])
                yield frame.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(run, schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), revisits resolved."""
    heads = read_headers(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    originals = heads.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("original_bytes"))
    resolved = heads.join(originals, "payload_digest", "left")
    return resolved.select("page_id", F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
