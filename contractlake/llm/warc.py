"""Web archives (WARC 1.1): writing, reading and revisit resolution.

Headers are shuffled by payload digest: of the records with one payload the one with the largest page id keeps it
as response, the others become revisits that name it. The digest's winner is a pre-aggregated maximum, written as a
table; records are then joined to it by digest (both sides plainly shuffled, so Spark can split the digest of a payload
that a third of all pages share) and written as new archives with fresh headers, the payload left out of revisits.

Archives are files of whole records: every record ends in two empty lines, which is also the line separator Spark's
text writer is given, so the files are written by Spark's own committer and survive lost executors. Reading goes
by Content-Length and never looks for a separator inside a payload.

Contract: a null payload is empty; a null url is an empty URI and is read back as null; a null page id is written without
an id and counts as smallest; rows that repeat the winning page id of their payload are responses too; payloads below
``min_bytes`` are always responses; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlake.llm.stage import new_folder, saved

#: What ends a record.
END = "\r\n\r\n"
#: Records of a file at most: a reader holds a file at a time.
RECORDS_PER_FILE = 1000
DATE = "2026-01-01T00:00:00Z"
READ = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each ten hex digits are eight digits of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Rows (page_id, url, payload, payload_digest, payload_bytes) with the headers' facts of each page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    return rows.withColumn("payload_digest", base32_sha1(F.col("payload").cast("binary"))).withColumn("payload_bytes", F.octet_length("payload").cast("long"))


def resolve(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``rows`` with record_type and refers_to. Only digests and ids are aggregated."""
    winners = saved(rows.where(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("_digest")).agg(F.max("page_id").alias("_first")), "originals")
    out = rows.join(winners, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= min_bytes), "left")
    response = F.col("_digest").isNull() | F.col("page_id").eqNullSafe(F.col("_first"))
    return (out.withColumn("record_type", F.when(response, "response").otherwise("revisit"))
            .withColumn("refers_to", F.when(~response, F.col("_first"))).drop("_digest", "_first"))


def write(resolved: DataFrame, path: str) -> None:
    """Archives of the rows (page_id, url, payload, payload_digest, payload_bytes, record_type, refers_to): gzipped files of whole records."""
    def name(col: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.col(col).cast("string"), F.lit(">"))

    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    empty = F.lit("")
    text = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), F.when(F.col("page_id").isNotNull(), line("WARC-Record-ID", name("page_id"))).otherwise(empty),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", " "))).otherwise(empty), line("WARC-Date", F.lit(DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))), line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                                 F.when(F.col("refers_to").isNotNull(), line("WARC-Refers-To", name("refers_to"))).otherwise(empty))).otherwise(empty),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length("_block").cast("string")), F.lit("\r\n"), F.col("_block"))
    resolved.withColumn("_block", block).select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(archive: bytes) -> Iterator[dict]:
    """The records of one archive file."""
    at = 0
    while at < len(archive):
        head_end = archive.index(b"\r\n\r\n", at)
        head = dict(x.split(": ", 1) for x in archive[at:head_end].decode("utf-8", "replace").split("\r\n")[1:])
        start = head_end + 4
        end = start + int(head["Content-Length"])
        body = archive.index(b"\r\n\r\n", start, end) + 4
        number = lambda key: int(head[key].rsplit(":", 1)[1].rstrip(">")) if key in head else None
        yield {"page_id": number("WARC-Record-ID"), "url": head.get("WARC-Target-URI"), "record_type": head["WARC-Type"],
               "payload_digest": head["WARC-Payload-Digest"].removeprefix("sha1:"), "payload_bytes": int(head["X-Payload-Length"]),
               "refers_to": number("WARC-Refers-To"), "payload": archive[body:end] if head["WARC-Type"] == "response" else None}
        at = end + len(END)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of archives that ``write`` made. A response whose payload doesn't have its digest fails the job."""
    schema = READ if payloads else READ.replace(", payload binary", "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = []
                for record in parse(zlib.decompress(content.as_py(), wbits=31) if content.as_py() else b""):
                    if record["payload"] is not None and base64.b32encode(hashlib.sha1(record["payload"]).digest()).decode() != record["payload_digest"]:
                        raise ValueError(f"payload of record {record['page_id']} doesn't have its digest")
                    if not payloads:
                        del record["payload"]
                    found.append(record)
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=arrow)

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, schema)


def dedup_archives(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> DataFrame:
    """Archives at ``source`` written anew at ``target``: repeated payloads as revisits, revisits of the source joined to their originals. Returns the new records' headers."""
    old = saved(read(spark, source), "archive")
    known = old.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("_d")).agg(F.max("page_id").alias("_id"))
    originals = saved(old.where("record_type = 'response'").join(known, (F.col("payload_digest") == F.col("_d")) & F.col("page_id").eqNullSafe(F.col("_id")))
                      .groupBy("_d").agg(F.first("payload").alias("_payload")), "payloads")
    whole = old.join(originals, F.col("payload_digest") == F.col("_d"), "left").withColumn("payload", F.coalesce("payload", "_payload").cast("string")).drop("_d", "_payload", "record_type", "refers_to")
    write(resolve(saved(whole, "whole"), min_bytes), target)
    return read(spark, target, payloads=False)


def archived(pages: DataFrame, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Writes deduplicated archives of a page table and returns the headers read back from them, one row per page."""
    path = path or new_folder(pages.sparkSession, "warc")
    write(resolve(records(pages), min_bytes), path)
    return read(pages.sparkSession, path, payloads=False)
