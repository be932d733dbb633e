"""WARC archives without repeated payloads.

Headers (page, payload digest) are shuffled by digest to choose the original response of
each payload; every other page with that payload becomes a revisit record that refers to it,
made from its header alone. Payloads meet nothing but the list of revisits, by digest and
page, so that equal payloads do not gather in one task. Records are written by Spark's own
text writer, whose line separator is the blank line that ends a WARC record, so archives land
wherever Spark can write, in gzip. They are read back piece by piece between such blank
lines, a record at a time, and revisits are joined to their responses by record id.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from base64 import b32encode
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecall.llm.common import written

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = (
    "page_id long, url string, record_id string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to_id string, payload string"
)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, html: str | None, digest: str, original: int | None, revisit: bool, date: str) -> str:
    """One record without the blank line at its end."""
    body = HTTP + ("" if revisit else html)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(body.encode()))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        headers.append(("Page-Id", str(page_id)))
    if revisit:
        headers += [("WARC-Refers-To", record_id(original, digest)), ("WARC-Profile", PROFILE)]
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n" + body


def resolve(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, digest (hex), original (page_id of the response), revisit.

    `html` is NULL for revisits.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1("html"))
    headers = written(rows.select("page_id", "url", "digest", (F.octet_length("html") >= least_bytes).alias("counts")))
    originals = headers.filter("counts").groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
    # Written, so that the join is between two scans and a digest of many pages can be split.
    originals = written(originals.filter("n > 1 AND original IS NOT NULL").drop("n"))
    again = ~F.col("page_id").eqNullSafe(F.col("original"))
    revisits = written(headers.join(originals, "digest").filter(again).select("page_id", "url", "digest", "original"))
    taken = revisits.select(F.col("digest").alias("_digest"), F.col("page_id").alias("_page_id")).distinct()
    same = (F.col("digest") == F.col("_digest")) & F.col("page_id").eqNullSafe(F.col("_page_id"))
    responses = rows.join(taken, same, "left_anti").select(
        "page_id", "url", "html", "digest", F.lit(None).cast("long").alias("original"), F.lit(False).alias("revisit")
    )
    return responses.unionByName(
        revisits.withColumn("html", F.lit(None).cast("string")).withColumn("revisit", F.lit(True))
    )


def write_archives(
    pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", records_per_file: int = 5_000
) -> None:
    """Write one record per row of `pages` (page_id, url, html) into gzipped WARC files.

    Of the rows with equal payloads of at least `least_bytes` bytes, the one with the largest
    page_id is a response and the others are revisits of it; smaller payloads are all
    responses. NULL html is an empty payload; a NULL page_id counts as smaller than any, and
    payloads of NULL ids alone are all responses; rows that repeat the largest page_id are
    responses each; NULL urls are left out. No rows give no records. Other columns are not read.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                record(p, u, h, b32encode(bytes.fromhex(d)).decode(), o, r, date)
                for p, u, h, d, o, r in zip(*[batch.column(c).to_pylist() for c in names])
            ]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["value"])

    names = ["page_id", "url", "html", "digest", "original", "revisit"]
    records = resolve(pages, least_bytes).select(*names).mapInArrow(work, "value string")
    writer = records.write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_file).text(path)


class Records:
    """Takes the bytes of one archive as they come and gives its records as (headers, body)."""

    def __init__(self):
        self.rest = bytearray()
        self.headers: dict[str, str] | None = None
        self.need = 0

    def take(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.rest += piece
        while True:
            if self.headers is None:
                end = self.rest.find(END.encode())
                if end <= 0:  # no record begins with a blank line: see `close`
                    return
                version, *lines = self.rest[:end].decode().split("\r\n")
                if version != "WARC/1.1":
                    raise ValueError(f"not a WARC record: {version[:40]!r}")
                self.headers = dict(line.split(": ", 1) for line in lines)
                self.need = int(self.headers["Content-Length"])
                del self.rest[: end + len(END)]
            if len(self.rest) < self.need + len(END):
                return
            body = bytes(self.rest[: self.need])
            if self.rest[self.need : self.need + len(END)] != END.encode():
                raise ValueError(f"record {self.headers['WARC-Record-ID']} has no end")
            del self.rest[: self.need + len(END)]
            headers, self.headers = self.headers, None
            yield headers, body

    def close(self) -> None:
        # The last piece of a file may bring a blank line too many.
        if self.headers is not None or self.rest not in (b"", END.encode()):
            raise ValueError("an archive ends within a record")


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records below `path` as they are. `payload` is NULL for revisits, and throughout
    without `payloads`. A task holds one record at a time, whatever the size of a file."""

    def row(h: dict[str, str], body: bytes) -> tuple:
        payload = body.partition(b"\r\n\r\n")[2]
        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
        own = h["WARC-Type"] == "response"
        if own and b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"record {h['WARC-Record-ID']} has another payload than its digest says")
        return (
            int(h["Page-Id"]) if "Page-Id" in h else None, h.get("WARC-Target-URI"), h["WARC-Record-ID"],
            h["WARC-Type"], digest, len(payload) if own else None, h.get("WARC-Refers-To"),
            payload.decode() if own and payloads else None,
        )

    types = [pa.int64(), *[pa.string()] * 4, pa.int64(), *[pa.string()] * 2]
    names = [f.split()[0] for f in RECORD.split(", ")]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, records = None, Records()
        for batch in batches:
            found = []
            pieces = batch.column("value").cast(pa.binary())
            for name, piece in zip(batch.column("file").to_pylist(), pieces):
                if name != file:
                    records.close()
                    file, records = name, Records()
                found += [row(h, body) for h, body in records.take(piece.as_py() + END.encode())]
            columns = list(zip(*found)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
        records.close()

    # A gzip file is read by one task, in its order.
    files = spark.read.option("lineSep", END).option("pathGlobFilter", "part-*.gz").text(path)
    return files.select("value", F.input_file_name().alias("file")).mapInArrow(work, RECORD)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records with revisits resolved: payload_bytes and payload of the response, and
    `refers_to`, its page_id."""
    records = read_records(spark, path, payloads)
    # Rows that repeat a page repeat its record; their payloads are the same.
    responses = records.filter("record_type = 'response'").dropDuplicates(["record_id"])
    responses = responses.select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("_bytes"), F.col("payload").alias("_payload"),
    )
    joined = records.join(responses, "refers_to_id", "left")
    return joined.select(
        "page_id", "url", "record_type", "payload_digest", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        "refers_to", F.coalesce("payload", "_payload").alias("payload"),
    )
