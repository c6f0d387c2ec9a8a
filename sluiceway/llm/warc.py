"""WARC archives as streams, and a table of record chunks read back from them."""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import Staged, new_path, remove, store

#: Bytes of a payload that are in memory at once, and of a chunk row.
CHUNK_BYTES = 1 << 20
#: Payloads under this size are written again, not referred to.
LEAST_REVISIT = 100
#: A task goes on to a next archive beyond this size.
ARCHIVE_BYTES = 1 << 30
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENDS = b"\r\n\r\n"


def record_id(key: object) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{key}').urn}>"


def header(key: int | None, uri: str | None, size: int, digest: str, first: int | None, revisit: bool, date: str) -> bytes:
    """The WARC fields and the HTTP fields before a payload; a revisit has no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(key)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else size)}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if key is not None:
        fields.append(f"X-Record-Key: {key}")
    if uri is not None:  # a line end would end the field
        fields.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", uri))
    if revisit:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first)}", f"X-Refers-To-Key: {first}"]
    return "\r\n".join(fields).encode() + ENDS + http


class ArchiveWriter:
    """Gzip members, one a record, in files of about a given size; payloads go through in chunks."""

    def __init__(self, folder: str, date: str, archive_bytes: int):
        self.files, self.base = store(folder)
        self.folder, self.date, self.archive_bytes = folder, date, archive_bytes
        self.files.create_dir(self.base, recursive=True)
        self.sink = None
        self.done: list[tuple[str, int]] = []
        self.records = 0

    def add(self, key: int | None, uri: str | None, payload: memoryview, digest: str, first: int | None, revisit: bool) -> None:
        if self.sink is None:  # every attempt of a task has names of its own; only those it reports are read
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.sink, self.records = self.files.open_output_stream(f"{self.base}/{self.name}"), 0
        with gzip.GzipFile(fileobj=self.sink, mode="wb", compresslevel=1, mtime=0) as member:
            member.write(header(key, uri, len(payload), digest, first, revisit, self.date))
            if not revisit:
                for start in range(0, len(payload), CHUNK_BYTES):
                    member.write(payload[start : start + CHUNK_BYTES])
            member.write(ENDS)
        self.records += 1
        if self.sink.tell() >= self.archive_bytes:
            self.close()

    def close(self) -> list[tuple[str, int]]:
        if self.sink is not None:
            self.sink.close()
            self.sink = None
            self.done.append((f"{self.folder}/{self.name}", self.records))
        return self.done


def write_archives(
    pages: DataFrame, folder: str, key: str, uri: str, body: str, date: str = "2000-01-01T00:00:00Z",
    least_revisit: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES,
) -> Staged:
    """A record per row into archives of the folder; the table returned names them and their records.

    Of equal payloads of at least ``least_revisit`` bytes the one with the smallest key is a response,
    and so are repeated rows of that key; the others revisit it. A null body is an empty payload; a
    null key or URI leaves its field out. Digests are reduced before the shuffle, and a payload is
    shuffled once, next to its digest's first key; the join may split a common digest.
    """
    payload = F.coalesce(F.col(body), F.lit(""))
    rows = pages.select(
        F.col(key).alias("record_key"), F.col(uri).alias("uri"), payload.alias("payload"),
        F.sha2(F.encode(payload, "UTF-8"), 256).alias("digest"),
    )
    firsts = (
        rows.where(F.octet_length("payload") >= least_revisit)
        .groupBy("digest")
        .agg(F.min("record_key").alias("first_key"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("digest", "first_key")
    )
    revisit = F.col("first_key").isNotNull() & ~F.col("first_key").eqNullSafe(F.col("record_key"))
    ready = rows.join(firsts, "digest", "left").select(
        "record_key", "uri", "payload", "digest", "first_key", revisit.alias("revisit")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, date, archive_bytes)
        for batch in batches:
            keys, uris, bodies, digests, first_keys, revisits = batch.columns
            for i in range(batch.num_rows):
                whole = bodies[i].as_buffer()  # no copy of the payload
                writer.add(
                    keys[i].as_py(), uris[i].as_py(), memoryview(whole), digests[i].as_py(), first_keys[i].as_py(), revisits[i].as_py()
                )
        done = writer.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
            names=["archive", "records"],
        )

    return Staged(ready.mapInArrow(write, "archive string, records long"), "archives")


def read_fields(stream) -> dict[str, str]:
    """Fields up to an empty line; none at the end of the stream."""
    fields: dict[str, str] = {}
    while (line := stream.readline().decode().rstrip("\r\n")):
        name, colon, value = line.partition(":")
        fields[name.lower()] = value.strip() if colon else ""
    return fields


def chunks(stream, chunk_bytes: int) -> Iterator[dict]:
    """The chunk rows of an archive; a digest goes along from chunk to chunk of a record."""
    while True:
        while (line := stream.readline()) in (b"\r\n", b"\n"):
            continue
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record where one should start: {line[:40]!r}")
        fields = read_fields(stream)
        rest, http = int(fields["content-length"]), {}
        if fields.get("content-type", "").startswith("application/http"):
            raw = b""
            while not raw.endswith(ENDS) and len(raw) < rest:
                raw += stream.readline()
            rest -= len(raw)
            http = {a.lower(): b.strip() for a, _, b in (x.partition(":") for x in raw.decode("latin-1").split("\r\n"))}
        kind = fields["warc-type"]
        row = {
            "record_key": int(fields["x-record-key"]) if "x-record-key" in fields else None,
            "record_id": fields["warc-record-id"],
            "record_type": kind,
            "target_uri": fields.get("warc-target-uri"),
            "refers_to": int(fields["x-refers-to-key"]) if "x-refers-to-key" in fields else None,
            "stated_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
            "stated_bytes": int(http.get("content-length", rest)),
        }
        digest, number, offset = hashlib.sha256(), 0, 0
        while True:
            part = stream.read(min(chunk_bytes, rest))
            if len(part) < min(chunk_bytes, rest):
                raise ValueError(f"{row['record_id']}: the archive ends within its payload")
            rest -= len(part)
            digest.update(part)
            yield row | {
                "chunk_number": number, "chunk_offset": offset, "chunk": part,
                "sha256_so_far": digest.hexdigest(), "last": rest == 0,
            }
            number, offset = number + 1, offset + len(part)
            if not rest:
                break


CHUNK_SCHEMA = pa.schema(
    [
        ("record_key", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
        ("refers_to", pa.int64()), ("stated_digest", pa.string()), ("stated_bytes", pa.int64()), ("chunk_number", pa.int64()),
        ("chunk_offset", pa.int64()), ("chunk_bytes", pa.int64()), ("chunk", pa.binary()), ("sha256_so_far", pa.string()), ("last", pa.bool_()),
    ]
)
CHUNK_DDL = (
    "record_key long, record_id string, record_type string, target_uri string, refers_to long, stated_digest string, "
    "stated_bytes long, chunk_number long, chunk_offset long, chunk_bytes long, chunk binary, sha256_so_far string, last boolean"
)


def read_chunks(archives: DataFrame, with_payload: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row per record and chunk of the archives named in column ``archive``; an empty payload has one.

    ``sha256_so_far`` is the digest of the payload up to the chunk's end. Without ``with_payload``
    chunks are read and digested, and left out of the rows. A task reads one archive at a time and
    holds at most some chunks.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, place = store(path)
                with files.open_input_stream(place) as raw, gzip.GzipFile(fileobj=raw, mode="rb") as stream:
                    for row in chunks(stream, chunk_bytes):
                        row["chunk_bytes"] = len(row["chunk"])
                        if not with_payload:
                            row["chunk"] = None
                        rows.append(row)
                        held += row["chunk_bytes"] * with_payload
                        if len(rows) >= 5000 or held >= 8 * CHUNK_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, CHUNK_SCHEMA)
                            rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, CHUNK_SCHEMA)

    return archives.select("archive").mapInArrow(read, CHUNK_DDL)


def archive_round_trip(pages: DataFrame, key: str = "page_id", uri: str = "url", body: str = "html", least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """Write all pages, read the archives back, and return a row per record: key, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``. What is read counts, not what was written: a
    response's figures come from its payload, a revisit's from its fields. No pages give no rows;
    other columns are not read.
    """
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    manifest = write_archives(pages, folder, key, uri, body, least_revisit=least_revisit).read()
    archives = manifest.count()
    last = read_chunks(manifest.repartition(max(1, archives)), with_payload=False).where("last")
    response = F.col("record_type") == "response"
    kind = pages.schema[key].dataType
    found = Staged(
        last.select(
            F.col("record_key").cast(kind).alias(key),
            F.when(response, F.col("chunk_offset") + F.col("chunk_bytes")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
            F.when(response, F.col("sha256_so_far")).otherwise(F.col("stated_digest")).alias("payload_digest"),
            "record_type",
            F.col("refers_to").cast(kind).alias("refers_to"),
        ),
        "records",
    )
    remove(spark, folder)
    return found.read()
