"""WARC archives: one gzip member per record, written by tasks and read in sequence.

Payloads that occur again become revisit records, which hold no payload and name
the response they repeat. The reader decompresses in small steps, frames records
by their Content-Length and verifies both digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any, BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsaw.llm.shards import create, frugal, new_folder, opened, saved
from bandsaw.operators.skew import lookup
from bandsaw.session import shuffle_partitions

# The version line, the profile of identical payloads, and the ends of lines and heads.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n"
END_OF_HEAD = b"\r\n\r\n"

FILE_BYTES = 64 << 20  # of records, before compression, after which a task starts a new file
STEP = 64 << 10
LEVEL = 6
ID_FIELD = "WARC-Page-ID"
MANIFEST = "file string, records bigint"
RECORDS = "record_id string, page_id bigint, record_type string, refers_to_id string, url string, payload_bytes bigint, payload_digest string, declared_digest string, verified boolean"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_uri(page_id: int | None, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}').urn}>"


def _one_line(value: str) -> str:
    """A header value: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool, date: str) -> bytes:
    """One record, not compressed. A revisit holds the HTTP head alone, with the length of the full payload."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    fields = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", record_uri(page_id, digest)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if page_id is not None:
        fields.append((ID_FIELD, str(page_id)))
    if is_revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_uri(refers_to, digest))]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in fields)]).encode() + END_OF_HEAD
    return head + block + END_OF_HEAD


def planned(pages: DataFrame, key: str, url: str, payload: str, least: int) -> DataFrame:
    """(page_id, url, payload, refers_to, is_revisit): of equal payloads of ``least`` bytes or more the smallest id responds."""
    body = F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("n", F.octet_length("payload"))
    firsts = rows.filter(F.col("n") >= least).groupBy("digest").agg(F.min("page_id").alias("first"))
    known = lookup(rows, firsts, ["digest"], "left")
    again = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    return known.select("page_id", "url", "payload", F.when(again, F.col("first")).alias("refers_to"), again.alias("is_revisit"))


def write_warc(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
    least: int = 0, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write archives below ``folder``; the result is the manifest, one row per file.

    A null payload is empty; a null URL leaves its field out. A null id responds
    only where no other id has the payload. Rows that share the smallest id all
    respond. An empty table writes no file. Further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = uri = None
        size = count = 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if sink is None:
                    sink, uri = create(folder, ".warc.gz")
                data = record(row["page_id"], row["url"], row["payload"], row["refers_to"], row["is_revisit"], date)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                sink.write(packer.compress(data) + packer.flush())
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    sink.close()
                    done.append((uri, count))
                    sink, size, count = None, 0, 0
        if sink is not None:
            sink.close()
            done.append((uri, count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["file", "records"])

    return planned(pages, key, url, payload, least).mapInArrow(frugal(run), MANIFEST)


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes
    own_member: bool  # the gzip member ended with the record
    errors: list[str] = field(default_factory=list)

    @property
    def payload(self) -> bytes:
        """The body behind the HTTP head, or the whole block if it has none."""
        if self.fields.get("content-type", "").startswith("application/http"):
            return self.block.partition(END_OF_HEAD)[2]
        return self.block


class SequentialReader:
    """Records of a stream of gzip members, with one record and one step of input in memory."""

    def __init__(self, source: BinaryIO | Any, step: int = STEP):
        self.source, self.step = source, step
        self.unpacker = zlib.decompressobj(31)
        self.packed, self.held = b"", bytearray()
        self.ended = self.begun = False  # of the current member

    def _more(self) -> bool:
        """Decompress one step; False at the end of the stream."""
        if self.ended:
            self.packed = self.unpacker.unused_data or self.source.read(self.step)
            if not self.packed:
                return False
            self.unpacker, self.ended, self.begun = zlib.decompressobj(31), False, False
        elif not self.packed:
            self.packed = self.source.read(self.step)
            if not self.packed:
                if self.begun:
                    raise ValueError("the last gzip member is cut off")
                return False
        self.begun = True
        self.held += self.unpacker.decompress(self.packed, self.step)
        self.packed = self.unpacker.unconsumed_tail
        self.ended = self.unpacker.eof
        return True

    def _until(self, size: int) -> bool:
        while len(self.held) < size:
            if not self._more():
                return False
        return True

    def __iter__(self) -> Iterator[Record]:
        while True:
            at = -1
            while (at := self.held.find(END_OF_HEAD)) < 0:
                if not self._more():
                    if self.held.strip():
                        raise ValueError("the archive ends within a record's head")
                    return
            version, *lines = self.held[:at].decode("utf-8", "replace").split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError(f"not a record: {version[:40]!r}")
            fields: dict[str, str] = {}
            for line in lines:
                name, _, value = line.partition(":")
                fields[name.strip().lower()] = value.strip()
            begin, size = at + len(END_OF_HEAD), int(fields["content-length"])
            if not self._until(begin + size + len(END_OF_HEAD)):
                raise ValueError("the archive ends within a record's block")
            block = bytes(self.held[begin : begin + size])
            if self.held[begin + size : begin + size + 4] != END_OF_HEAD:
                raise ValueError("the record is longer than its Content-Length")
            del self.held[: begin + size + len(END_OF_HEAD)]
            while not self.ended and not self.held and self._more():
                pass
            out = Record(fields, block, self.ended and not self.held)
            if out.fields.get("warc-block-digest", "sha1:" + base32_sha1(block)) != "sha1:" + base32_sha1(block):
                out.errors.append("block digest")
            if not out.own_member:
                out.errors.append("gzip member")
            if fields.get("warc-type") != "revisit" and fields.get("warc-payload-digest", "") not in ("", "sha1:" + base32_sha1(out.payload)):
                out.errors.append("payload digest")
            yield out


def read_warc(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the files that ``manifest`` names, one row each, and their ``payload`` if wanted.

    A revisit has no payload; its bytes and digest come from ``resolved``.
    ``verified`` tells that digests hold and the record had a gzip member of its own.
    """
    schema = RECORDS + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]

    def row(r: Record) -> list:
        get = r.fields.get
        revisit = get("warc-type") == "revisit"
        page = get(ID_FIELD.lower())
        payload = None if revisit else r.payload
        out = [get("warc-record-id"), int(page) if page else None, get("warc-type"), get("warc-refers-to"), get("warc-target-uri")]
        out += [None if revisit else len(payload), None if revisit else base32_sha1(payload), (get("warc-payload-digest") or "").removeprefix("sha1:"), not r.errors]
        return [*out, payload] if with_payload else out

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                store, path = opened(file)
                with store.open_input_stream(path) as source:
                    rows, size = [], 0
                    for r in SequentialReader(source):
                        rows.append(row(r))
                        size += len(r.block) if with_payload else 512
                        if size >= 1 << 21:
                            yield batch_of(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch_of(rows)

    # a number of its own: the few rows would else be gathered in one task
    parts = shuffle_partitions(manifest.sparkSession)
    return manifest.select("file").repartition(parts, "file").mapInArrow(frugal(run), schema)


def resolved(records: DataFrame) -> DataFrame:
    """Page rows from records: a revisit takes bytes and digest from the response that it names."""
    responses = records.filter("record_type = 'response'")
    # rows that share an id and a payload share a record id
    named = responses.groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("b"), F.first("payload_digest").alias("d")
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    own = responses.select(*columns, F.lit(None).cast("bigint").alias("refers_to"), "verified")
    again = records.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    again = lookup(again, named, ["refers_to_id"], "left")
    agreed = F.col("verified") & F.coalesce(F.col("d") == F.col("declared_digest"), F.lit(False))
    return own.unionByName(
        again.select("page_id", F.col("b").alias("payload_bytes"), F.col("d").alias("payload_digest"), "record_type", "refers_to", agreed.alias("verified"))
    )


def archived(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    manifest = saved(write_warc(pages, new_folder(spark, "warc"), least=least), "warc-manifest")
    return resolved(saved(read_warc(manifest, with_payload=False), "warc-records"))


#: DuckDB text for the rows of ``archived`` over ``pages``. A group of eight characters holds 40 bits, ten hexadecimal digits.
SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hex, 1 + 10 * (i // 8), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, true AS verified
FROM f
"""
