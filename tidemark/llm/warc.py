"""Operator 6: web archives, from one gzip stream a file to one gzip member a record.

* ``write_monolithic`` writes pages as WARC 1.1 records, each file a single gzip stream, as
  ``gzip pages.warc`` makes it. Such a file cannot be read from the middle.
* ``normalise`` inflates each such file once, as a stream, rewrites every record as a gzip
  member of its own, and writes a sidecar index of offsets beside it. Neither a file nor a
  payload is held whole.
* ``read_members`` reads the records back through the index, one seek each.

Pages with equal payloads of at least ``least`` bytes are stored once: the row with the
largest page_id is a ``response``, the others are ``revisit`` records that name it. Their
digests are grouped, never their payloads: a page copied by a third of all rows is one
group row joined back by a join that adaptive execution can split.

Defined results: a null html is an empty payload; null page_ids are never named by a
revisit, and a group of nothing else is all responses; if the largest page_id repeats, each
of its rows is a response; a null url leaves the header out; an empty table writes no file.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.blocks import small_batches
from tidemark.llm.files import finished_file, open_file
from tidemark.llm.tables import chunks, stored
from tidemark.session import work_folder

SHARED_BYTES = 1000
FILE_BYTES = 32 << 20
PIECE = 1 << 20
LEVEL = 6
GZIP = 31  # zlib's window bits for a gzip wrapper

FILES = "file string, records long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long, length long"


def with_record_types(pages: DataFrame, least: int = SHARED_BYTES) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, record_type, refers_to``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id",
        "url",
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
    )
    copies = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("payload_digest").alias("digest"), "first_id")
    )
    joined = rows.join(copies, rows.payload_digest == copies.digest, "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        *rows.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "none") else None


def record_parts(row: dict) -> Iterator[bytes]:
    """One record: its header, its HTTP header, and for a response the payload."""
    payload = row["html"].encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = len(http) + (0 if revisit else len(payload))
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {record_name(row['page_id'])}"]
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + row["url"].replace("\r", "%0D").replace("\n", "%0A"))
    head += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{row['payload_digest']}"]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_name(row['refers_to'])}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {block}"]
    yield "\r\n".join(head).encode() + b"\r\n\r\n"
    yield http
    if not revisit:
        yield payload
    yield b"\r\n\r\n"


def write_monolithic(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = 1) -> DataFrame:
    """Writes the rows of ``with_record_types`` and returns the files, as a stored table."""
    arrow = to_arrow_schema(StructType.fromDDL(FILES))

    def write(batches):
        part = TaskContext.get().partitionId()
        for number, rows in enumerate(chunks(batches, "html", file_bytes)):
            name = f"{folder}/pages-{part:06d}-{number:04d}.warc.gz"
            with finished_file(name) as out:
                packer = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                for i in range(rows.num_rows):
                    for piece in record_parts(rows.slice(i, 1).to_pylist()[0]):
                        out.write(packer.compress(piece))
                out.write(packer.flush())
            yield pa.RecordBatch.from_pylist([{"file": name, "records": rows.num_rows}], schema=arrow)

    return stored(pages.mapInArrow(write, FILES), "warc-files")


class Inflated:
    """The bytes of a gzip file, of one member or many, read forward in pieces."""

    def __init__(self, stream):
        self.stream = stream
        self.unpacker = zlib.decompressobj(GZIP)
        self.rest = b""
        self.ready = bytearray()

    def _fill(self) -> bool:
        while True:
            data = self.rest or self.stream.read(PIECE)
            if not data:
                return False
            if self.unpacker.eof:
                self.unpacker = zlib.decompressobj(GZIP)
            got = self.unpacker.decompress(data, PIECE)
            self.rest = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
            if got:
                self.ready += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Everything up to and with ``mark``; None at the end of the file."""
        seen = 0
        while (at := self.ready.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.ready)
            if not self._fill():
                if self.ready.strip():
                    raise ValueError("the archive ends inside a record")
                return None
        found = bytes(self.ready[: at + len(mark)])
        del self.ready[: at + len(mark)]
        return found

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self._fill():
                raise ValueError("the archive ends inside a record")
            piece = bytes(self.ready[:n])
            del self.ready[:n]
            n -= len(piece)
            yield piece


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode().strip().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    return {name.strip(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def normalise(files: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Each file again with one gzip member a record, and ``.idx`` lines of offset, length and header."""
    arrow = to_arrow_schema(StructType.fromDDL(FILES))

    def rewrite(name: str) -> dict:
        target = f"{folder}/{name.rpartition('/')[2]}"
        records = offset = 0
        with open_file(name) as raw, finished_file(target) as out, finished_file(f"{target}.idx") as index:
            source = Inflated(raw)
            while (head := source.until(b"\r\n\r\n")) is not None:
                packer = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                fields = header_fields(head)
                start = offset
                offset += out.write(packer.compress(head))
                for piece in source.pieces(int(fields["Content-Length"])):
                    offset += out.write(packer.compress(piece))
                if b"".join(source.pieces(4)) != b"\r\n\r\n":
                    raise ValueError("a record does not end where its length says")
                offset += out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                line = {"offset": start, "length": offset - start, "id": fields["WARC-Record-ID"], "type": fields["WARC-Type"]}
                index.write(json.dumps(line).encode() + b"\n")
                records += 1
        return {"file": target, "records": records}

    def each(batches):
        for batch in batches:
            for name in batch.column("file").to_pylist():
                yield pa.RecordBatch.from_pylist([rewrite(name)], schema=arrow)

    return stored(files.repartition(_tasks(files), "file").mapInArrow(each, FILES), "warc-members")


def _tasks(files: DataFrame) -> int:
    """One task a file, as far as the cluster's default goes beyond it."""
    return max(1, min(files.count(), 4 * files.sparkSession.sparkContext.defaultParallelism))


def member(stream, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """The header and the payload of the record at an offset."""
    stream.seek(offset)
    record = zlib.decompress(stream.read(length), GZIP)
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = header_fields(head)
    http, _, body = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    fields["payload length"] = http.lower().partition(b"content-length:")[2].split(b"\r\n")[0].decode().strip()
    return fields, body


def read_members(files: DataFrame) -> DataFrame:
    """Every record through the sidecar index; a response's digest is taken of its payload anew."""
    arrow = to_arrow_schema(StructType.fromDDL(RECORDS))

    def records(name: str) -> Iterator[dict]:
        with open_file(name) as stream, open_file(f"{name}.idx") as index:
            for line in index.read().splitlines():
                at = json.loads(line)
                fields, body = member(stream, at["offset"], at["length"])
                digest, length = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["payload length"])
                if fields["WARC-Type"] == "response":
                    if (hashlib.sha1(body).hexdigest(), len(body)) != (digest, length):
                        raise ValueError(f"{name} at {at['offset']}: the payload is damaged")
                yield {
                    "page_id": page_of(fields["WARC-Record-ID"]),
                    "url": fields.get("WARC-Target-URI"),
                    "payload_bytes": length,
                    "payload_digest": digest,
                    "record_type": fields["WARC-Type"],
                    "refers_to": page_of(fields.get("WARC-Refers-To")),
                    "file": name,
                    "offset": at["offset"],
                    "length": at["length"],
                }

    def each(batches):
        rows = (r for b in batches for name in b.column("file").to_pylist() for r in records(name))
        return small_batches(rows, arrow)

    return files.repartition(_tasks(files), "file").mapInArrow(each, RECORDS)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Pages written as plain archives, normalised, and read back."""
    spark = pages.sparkSession
    plain = write_monolithic(with_record_types(pages), work_folder(spark, "warc-plain"))
    return read_members(normalise(plain, work_folder(spark, "warc-members")))
