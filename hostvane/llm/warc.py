"""Web archives with an index: every record's place is known, and records are read by coalesced byte ranges.

Pages are written as WARC/1.1 records, each a gzip member of its own, into archives in the shared folder. Of pages with
equal payloads the one with the smallest id is the response, the others are revisits that refer to it. A task that is
tried again writes a new archive; the index, a table that Spark commits, names only the archives of the tries that
counted. Readers sort the selected index rows by place, and fetch neighbouring records with one read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import itertools
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvane.llm.shared import small_batches, stored
from hostvane.session import work_dir

#: Archives are closed at this size; neighbours up to GAP apart are read at once, up to SPAN together.
ARCHIVE_BYTES, GAP, SPAN = 1 << 30, 64 << 10, 8 << 20
#: Bytes of archives that a task of the reader is given; compressed, they are a few times as many in memory, one run at a time.
TASK_BYTES = 32 << 20
#: Pages with fewer payload bytes are never revisits.
LEAST_BYTES = 0
DATE = "2026-01-01T00:00:00Z"

# Fixed values of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID_SPACE, _NO_ID = 0x686F737476616E65 << 64, 0x6E6F2D69642D2D2D << 64

INDEX_SCHEMA = "archive string, offset long, length long, url string, digest string, record_type string, page_id long"
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "intact boolean, payload binary"
)


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _record_id(page_id: int | None) -> str:
    return f"<{uuid.UUID(int=_NO_ID if page_id is None else _ID_SPACE | page_id & (1 << 64) - 1).urn}>"


def _page_id(record_id: str) -> int | None:
    value = uuid.UUID(record_id.strip("<>").removeprefix("urn:uuid:")).int
    low = value & (1 << 64) - 1
    return None if value >> 64 == _NO_ID >> 64 else low - (low >> 63 << 64)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", mtime=0)


def parse(member: bytes) -> tuple:
    """Values of RECORD_SCHEMA from a record; `intact` compares a response's payload with its digest and length."""
    whole = gzip.decompress(member)
    head, rest = whole.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    intact = True
    if kind == "response":
        intact = len(payload) == length and digest_text(hashlib.sha1(payload).digest()) == digest
    refers_to = _page_id(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return _page_id(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, refers_to, length, digest, intact, payload


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write every page as a record, and return the index (INDEX_SCHEMA) as a table in the shared folder.

    Payload: the html in UTF-8; null is empty. Equal payloads: the smallest page_id is the response, the others revisit
    it; rows that repeat both are written alike. Rows with a null page_id are revisits of an equal payload that has an
    id, else responses. A null url is left out. Other columns are ignored. An empty table gives an empty index.
    """
    spark = pages.sparkSession
    folder = folder or work_dir(spark, "archives")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    digest = F.unhex(F.sha1("payload"))
    first = rows.select(digest.alias("sha1"), F.octet_length("payload").alias("size"), "page_id").groupBy("sha1", "size").agg(F.min("page_id").alias("first"))
    marked = rows.withColumns({"sha1": digest, "size": F.octet_length("payload")}).join(first, ["sha1", "size"])
    marked = marked.withColumn("revisit", (F.col("size") >= least_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        archive = stream = None
        at = 0
        names = [part.split()[0] for part in INDEX_SCHEMA.split(", ")]
        try:
            for batch in small_batches(batches):
                out = []
                for row in batch.to_pylist():
                    if stream is None or at >= ARCHIVE_BYTES:
                        if stream:
                            stream.close()
                        archive = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                        stream, at = store.open_output_stream(fs.FileSystem.from_uri(archive)[1], compression=None), 0
                    named = digest_text(row["sha1"])
                    member = record(row["page_id"], row["url"], row["payload"], named, row["first"], row["revisit"])
                    stream.write(member)
                    kind = "revisit" if row["revisit"] else "response"
                    out.append((archive, at, len(member), row["url"], named, kind, row["page_id"]))
                    at += len(member)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
        finally:
            if stream:
                stream.close()

    return stored(marked.select("page_id", "url", "payload", "sha1", "first", "revisit").mapInArrow(write, INDEX_SCHEMA), "warc-index")


def ranges(places: Iterator[tuple[str, int, int]], gap: int = GAP, span: int = SPAN) -> Iterator[list[tuple[str, int, int]]]:
    """Runs of (archive, offset, length), in order of place, that one read fetches; a single record may exceed `span`."""
    run: list[tuple[str, int, int]] = []
    for place in places:
        if run:
            archive, start, _ = run[0]
            end = max(o + n for _, o, n in run[-1:])
            if place[0] != archive or place[1] > end + gap or place[1] + place[2] - start > span:
                yield run
                run = []
        run.append(place)
    if run:
        yield run


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that `index` names (any selection of its rows), as RECORD_SCHEMA; without payloads if not wanted."""
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    keep = len(names) - (not payloads)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def places() -> Iterator[tuple[str, int, int]]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True)

        source, opened = None, None
        for run in ranges(places()):
            if run[0][0] != opened:
                if source:
                    source.close()
                store, path = fs.FileSystem.from_uri(run[0][0])
                source, opened = store.open_input_file(path), run[0][0]
            start, end = run[0][1], run[-1][1] + run[-1][2]
            data = source.read_at(end - start, start)
            for part in itertools.batched(run, 512):
                out = [parse(data[o - start : o - start + n])[:keep] for _, o, n in part]
                columns = zip(zip(*out, strict=True), kinds, strict=False)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names[:keep])
        if source:
            source.close()

    places = index.select("archive", "offset", "length")
    stored_bytes = places.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]  # a task's work is these, not the index
    places = places.repartitionByRange(max(1, -(-stored_bytes // TASK_BYTES)), "archive", "offset")
    return places.sortWithinPartitions("archive", "offset").mapInArrow(read, ", ".join(RECORD_SCHEMA.split(", ")[:keep]))
