"""WARC archives: one gzip member per record (operator 5).

The writer puts each page into the archive of its partition, as a ``response``
record with the page as an HTTP body, or as a ``revisit`` record that refers
to the response with an equal payload. The reader goes through an archive in
sequence: it inflates one member at a time from a stream, frames the block by
Content-Length and verifies the block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import scratch_path
from .common import ship, text_or_empty
from .files import reading, this_task, writing

VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "<urn:page:{}>"
CHUNK = 1 << 16


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_roles(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``: of the pages with equal payloads
    of at least ``min_bytes`` bytes, that with the largest id is the response
    (``refers_to`` null), the others refer to it. Equality is by SHA-1, length
    and a second hash. Rows that repeat the largest id are all responses, as
    are rows without an id."""
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_or_empty(payload_col).alias("payload"))
    base = base.withColumn("_sha", F.sha1("payload")).withColumn("_len", F.octet_length("payload")).withColumn("_xx", F.xxhash64("payload"))
    same = ["_sha", "_len", "_xx"]
    groups = base.groupBy(*same).agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    refers = F.when((F.col("_n") > 1) & (F.col("_len") >= min_bytes) & (F.col("page_id") < F.col("_first")), F.col("_first"))
    return base.join(groups, same).select("page_id", "url", "payload", refers.alias("refers_to"))


def _header(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record, uncompressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", RECORD.format("" if page_id is None else page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _header(url or "")),
        ("WARC-Payload-Digest", "sha1:" + sha1_base32(payload)),
        ("WARC-Block-Digest", "sha1:" + sha1_base32(block)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if refers_to is not None:
        lines += [("WARC-Profile", REVISIT), ("WARC-Refers-To", RECORD.format(refers_to))]
    lines += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode()
    return head + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(source) -> Iterator[bytes]:
    """Inflated gzip members of a stream, one after another."""
    rest = b""
    while True:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not rest:
                rest = source.read(CHUNK)
                if not rest:
                    if parts:
                        raise ValueError("archive ends inside a record")
                    return
            parts.append(inflate.decompress(rest))
            rest = inflate.unused_data
        yield b"".join(parts)


def parse_record(data: bytes) -> dict:
    """Header fields (lower-case names), block and payload of a record; raises
    ValueError when the framing or a digest is wrong."""
    end = data.find(b"\r\n\r\n")
    lines = data[:end].split(b"\r\n")
    if end < 0 or lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.decode().partition(":") for line in lines[1:])}
    size = int(fields["content-length"])
    block = data[end + 4 : end + 4 + size]
    if len(block) != size or data[end + 4 + size :] != b"\r\n\r\n":
        raise ValueError("Content-Length does not frame the record")
    if fields["warc-block-digest"] != "sha1:" + sha1_base32(block):
        raise ValueError("block digest differs")
    payload = block[block.find(b"\r\n\r\n") + 4 :]
    if fields["warc-type"] == "response":
        if fields["warc-payload-digest"] != "sha1:" + sha1_base32(payload):
            raise ValueError("payload digest differs")
        if int(fields["x-payload-length"]) != len(payload):
            raise ValueError("X-Payload-Length differs")
    return {"fields": fields, "payload": payload}


def _page(record_id: str) -> int | None:
    number = record_id[len("<urn:page:") : -1]
    return int(number) if number else None


def write_archives(roles: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write ``page_id, url, payload, refers_to`` as one ``.warc.gz`` per
    partition; returns the list of files (``file, records``), written too."""
    spark = roles.sparkSession
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = this_task()
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        name, count = f"part-{part:05d}.warc.gz", 0

        def all_rows():
            yield first
            yield from batches

        with writing(f"{folder}/archives", name, attempt) as out:
            for rows in all_rows():
                for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in rows.columns)):
                    out.write(gzip_member(record_bytes(page_id, url, payload.encode(), refers_to, date)))
                    count += 1
        yield pa.record_batch([pa.array([name]), pa.array([count], pa.int64())], names=["file", "records"])

    roles.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "file string, records bigint").write.parquet(f"{folder}/files.parquet")
    return spark.read.parquet(f"{folder}/files.parquet")


SCHEMA = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the archives of ``folder``, one task per archive.
    ``payload`` is null for revisits; their length and digest are those of the
    full payload. A damaged record fails the read."""
    ship(spark)
    files = spark.read.parquet(f"{folder}/files.parquet").select("file")
    count = max(1, files.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name in rows.column(0).to_pylist():
                out, size = [], 0
                with reading(f"{folder}/archives", name) as source:
                    for data in members(source):
                        record = parse_record(data)
                        f = record["fields"]
                        kept = f["warc-type"] == "response"
                        out.append(
                            (
                                _page(f["warc-record-id"]), f["warc-target-uri"], f["warc-type"], int(f["x-payload-length"]),
                                f["warc-payload-digest"].removeprefix("sha1:"), None if kept else _page(f["warc-refers-to"]),
                                record["payload"] if kept else None,
                            )
                        )
                        size += len(data)
                        if size > 1 << 23:
                            yield _batch(out)
                            out, size = [], 0
                if out:
                    yield _batch(out)

    return files.repartition(count, "file").mapInArrow(run, SCHEMA)


def broken_revisits(records: DataFrame) -> DataFrame:
    """Of the records of ``read_archives`` the revisits whose response is not
    among them, or has another length or digest than they state."""
    own = records.where("record_type = 'revisit'")
    there = records.where("record_type = 'response' and page_id is not null")
    there = there.select(F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"))
    met = own.join(there.dropDuplicates(["refers_to", "_bytes", "_digest"]), "refers_to", "left")
    good = (F.col("payload_bytes") == F.col("_bytes")) & (F.col("payload_digest") == F.col("_digest"))
    found = met.groupBy("page_id", "refers_to", "payload_bytes", "payload_digest").agg(F.max(F.coalesce(good, F.lit(False))).alias("_good"))
    return found.where(~F.col("_good")).drop("_good")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def warc_round_trip(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write the pages as archives and read them back (see ``read_archives``).

    Null payloads are empty; null urls come back empty; line breaks in a url
    are percent-coded. Ids are integers or null. Extra columns are ignored. An
    empty table gives no archive and no rows."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    write_archives(page_roles(pages, id_col, payload_col, min_bytes), folder)
    return read_archives(spark, folder)
