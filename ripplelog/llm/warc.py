"""Web archives, and deduplicated ones in which repeated payloads are revisit records.

An archive file is a row of WARC 1.1 records, each a gzip member of its own, so that a record can be
read by its offset alone. Writers return an index: a header row for each record with the place of
the record. To resolve revisits only these rows are shuffled, by payload digest; payloads then go
from file to file, in the order of the files.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.frames import batches_of, cut
from ripplelog.llm.records import _filesystem
from ripplelog.session import workspace

#: Payloads of fewer bytes stay whole wherever they occur.
LEAST_BYTES = 100
#: Bytes of a file after which the next one begins, and of the part of a file that one task copies.
FILE_BYTES, PART_BYTES = 1 << 30, 32 << 20
_PIECE = 1 << 16

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
# Fixed values of the WARC format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION = "WARC/1.1"
#: Header fields and the index columns they hold; those with X- are this library's own.
_FIELDS = [
    ("WARC-Record-ID", "record_id", "<{}>"),
    ("WARC-Date", "date", "{}"),
    ("WARC-Target-URI", "uri", "{}"),
    ("WARC-Payload-Digest", "digest", "sha256:{}"),
    ("X-Page-ID", "page_id", "{}"),
    ("WARC-Refers-To", "refers_to_id", "<{}>"),
    ("WARC-Refers-To-Target-URI", "refers_to_uri", "{}"),
    ("X-Refers-To-Page-ID", "refers_to", "{}"),
]

INDEX = (
    "file string, offset bigint, length bigint, kind string, record_id string, page_id bigint, uri string, "
    "date string, digest string, payload_bytes bigint, refers_to bigint, refers_to_id string, refers_to_uri string"
)
_NAMES = [part.split()[0] for part in INDEX.split(", ")]


def _safe(text: str) -> str:
    """Text for a header line: control characters percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda x: f"%{ord(x[0]):02X}", text)


def record(head: dict, payload: bytes | None, level: int) -> bytes:
    """One compressed record; without payload, only the HTTP header stands in its block."""
    http = _HTTP if head["payload_bytes"] is not None else _HTTP.replace("Content-Length: {}\r\n", "")
    block = http.format(head["payload_bytes"]).encode() + (payload or b"")
    lines = [
        _VERSION,
        f"WARC-Type: {head['kind']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if head["kind"] == "revisit":
        lines.append(f"WARC-Profile: {_PROFILE}")
    for name, key, text in _FIELDS:
        if head[key] is not None:
            lines.append(f"{name}: {text.format(_safe(str(head[key])))}")
    pack = zlib.compressobj(level, wbits=31)
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return pack.compress(whole) + pack.flush()


def members(file: BinaryIO) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member of a file."""
    at, rest = 0, b""
    while True:
        unpack, out, used = zlib.decompressobj(wbits=31), [], 0
        while not unpack.eof:
            piece = rest or file.read(_PIECE)
            if not piece:
                if used:
                    raise ValueError(f"the record at {at} has no end")
                return
            out.append(unpack.decompress(piece))
            rest = unpack.unused_data
            used += len(piece) - len(rest)
        yield at, used, b"".join(out)
        at += used


def parsed(content: bytes) -> tuple[dict, bytes]:
    """Header fields by lower-case name (``version`` is the first line), and the block."""
    head, found, rest = content.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
    size = int(fields.get("content-length", -1))
    if not found or not first.startswith("WARC/") or not 0 <= size <= len(rest):
        raise ValueError("not a WARC record")
    return {"version": first, **fields}, rest[:size]


def _header(file: str, offset: int, length: int, content: bytes) -> tuple[dict, bytes] | None:
    """(index row, payload) of a response or revisit record; None for other records.

    The digest of a response is computed from its payload; a header that says otherwise is an error.
    """
    fields, block = parsed(content)
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    http, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        http, payload = b"", block
    said = fields.get("warc-payload-digest", "").removeprefix("sha256:").lower() or None
    if kind == "response":
        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
        if said and len(said) == 64 and said != digest:
            raise ValueError(f"the payload at {offset} of {file} doesn't have its digest")
    else:
        stated = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", http)
        digest, size, payload = said, int(stated[1]) if stated else None, b""
    whole = lambda name: int(fields[name]) if name in fields else None
    bare = lambda name: fields[name].strip("<>") if name in fields else None
    row = {
        "file": file, "offset": offset, "length": length, "kind": kind, "record_id": bare("warc-record-id"),
        "page_id": whole("x-page-id"), "uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
        "digest": digest, "payload_bytes": size, "refers_to": whole("x-refers-to-page-id"),
        "refers_to_id": bare("warc-refers-to"), "refers_to_uri": fields.get("warc-refers-to-target-uri"),
    }
    return row, payload


class _Writer:
    """Archive files of one task, named anew by each attempt; ``rows`` are the headers so far."""

    def __init__(self, folder: str, level: int, file_bytes: int):
        self.store, self.root = _filesystem(folder)
        self.store.create_dir(self.root, recursive=True)
        self.level, self.file_bytes = level, file_bytes
        self.out, self.name, self.at, self.rows = None, "", 0, []

    def add(self, head: dict, payload: bytes | None) -> None:
        if self.out is not None and self.at >= self.file_bytes:
            self.close()
        if self.out is None:
            part = TaskContext.get().partitionId()
            self.name, self.at = f"{part:06d}-{uuid.uuid4().hex}.warc.gz", 0
            self.out = self.store.open_output_stream(f"{self.root}/{self.name}", compression=None)
        data = record(head, payload, self.level)
        self.out.write(data)
        self.rows.append({**head, "file": self.name, "offset": self.at, "length": len(data)})
        self.at += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None

    def headers(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], _ARROW[n]) for n in _NAMES})


_ARROW = {
    name: pa.int64() if kind == "bigint" else pa.string()
    for name, kind in (part.split() for part in INDEX.split(", "))
}


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    uri_col: str = "url",
    html_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    level: int = 1,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Each page as a response record; returns the index, written to the shared folder.

    The payload is the html in UTF-8, empty if null. A null id or URL has no header line; control
    characters of a URL are percent-encoded. Repeated rows are records of their own. Other columns
    are not read. An empty table gives an empty index and no file. Memory is bounded by a batch of
    rows. Only files that the index names count, so what a lost task left does no harm.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches_of(batches, 8 << 20):
            out = out or _Writer(folder, level, file_bytes)
            payloads = batch.column(2).cast(pa.large_binary())
            for key, uri, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), payloads, strict=True):
                payload = data.as_py() or b""
                head = dict.fromkeys(_NAMES) | {
                    "kind": "response", "record_id": f"urn:uuid:{uuid.uuid4()}", "page_id": key, "uri": uri,
                    "date": date, "digest": hashlib.sha256(payload).hexdigest(), "payload_bytes": len(payload),
                }
                out.add(head, payload)
            yield out.headers()
        if out is not None:
            out.close()

    rows = pages.select(F.col(id_col).cast("bigint"), F.col(uri_col).cast("string"), F.col(html_col).cast("string"))
    return cut(rows.mapInArrow(write, INDEX), "warc-index")


def index_archives(paths: DataFrame, folder: str) -> DataFrame:
    """The index of archive files of any origin, named relative to the folder in column ``file``.

    A file is read record by record, by one task; records that are neither response nor revisit are
    passed over. A damaged record is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _filesystem(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with store.open_input_file(f"{root}/{name}") as file:
                    for at, length, content in members(file):
                        found = _header(name, at, length, content)
                        rows += [found[0]] if found else []
                        if len(rows) == 4096:
                            yield _batch(rows)
                            rows = []
                yield _batch(rows)

    return paths.select("file").mapInArrow(read, INDEX)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], _ARROW[n]) for n in _NAMES})


def resolve_revisits(index: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The index with the role each record is to have: ``kind`` and what it refers to.

    Of responses with one digest and at least ``least_bytes`` bytes, that with the smallest id (null
    ids last, equal ids by URI and place) stays, the others become revisits of it. A revisit record
    is joined to that response as well; one whose response is in no archive stays as it is. Smaller
    responses stay; a revisit of a small payload is joined to the first of them.

    ``index`` is read several times: pass a table. Header rows are shuffled, never payloads. A digest
    with more than a thousandth of all rows is joined by a broadcast, and there can't be more than a
    thousand such digests; no other key has more rows than that in the shuffled join.
    """
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "uri", "file", "offset", "record_id")
    first = F.min(F.when(F.col("kind") == "response", rank))
    small = F.coalesce(F.col("payload_bytes") < least_bytes, F.lit(False)) & (F.col("kind") == "response")
    own = index.where(F.col("digest").isNotNull())
    groups = own.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    groups = cut(groups.where("first IS NOT NULL"), "originals")
    total = index.count()
    hot = F.broadcast(groups.where(F.col("rows") * 1000 > total))  # fewer than 1000 rows
    rest = groups.where(F.col("rows") * 1000 <= total)

    alone = index.where(F.col("digest").isNull() | small)
    asked = own.where(~small)
    none = F.lit(None).cast(groups.schema["first"].dataType)
    joined = (
        asked.join(hot, "digest")
        .unionByName(asked.join(hot.select("digest"), "digest", "left_anti").join(rest, "digest", "left"))
        .unionByName(alone.withColumns({"first": none, "rows": F.lit(None).cast("bigint")}))
    )
    is_first = (F.col("file") == F.col("first.file")) & (F.col("offset") == F.col("first.offset"))
    revisit = F.coalesce(F.col("first").isNotNull() & ~is_first, F.lit(False))
    refers = {"refers_to": "page_id", "refers_to_id": "record_id", "refers_to_uri": "uri"}
    return joined.withColumns(
        {"kind": F.when(revisit, "revisit").otherwise(F.col("kind"))}
        | {name: F.when(revisit, F.col(f"first.{of}")).otherwise(F.col(name)) for name, of in refers.items()}
    ).select(_NAMES)


def _parts(index: DataFrame) -> DataFrame:
    """Index rows dealt out by part of a file, in the order of the file."""
    part = F.floor(F.col("offset") / PART_BYTES)
    width = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return index.repartition(width, "file", part).sortWithinPartitions("file", "offset")


def _contents(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple[dict, dict, bytes]]:
    """(index row, header found, payload) of the records that index rows name, file after file."""
    store, root = _filesystem(folder)
    file, name = None, None
    try:
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != name:
                    if file is not None:
                        file.close()
                    name = row["file"]
                    file = io.BufferedReader(store.open_input_file(f"{root}/{name}"), 1 << 20)
                file.seek(row["offset"])
                content = zlib.decompress(file.read(row["length"]), wbits=31)
                found = _header(name, row["offset"], row["length"], content)
                if found is None:
                    raise ValueError(f"no response or revisit at {row['offset']} of {name}")
                yield row, *found
    finally:
        if file is not None:
            file.close()


def write_deduplicated(
    index: DataFrame, folder: str, target: str, level: int = 6, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Copy the records of an index to new archives in the roles it gives them; returns their index.

    Headers are written afresh; a revisit has no payload. Each task goes through parts of the old
    files in order, so payloads are never shuffled.
    """

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for row, _, payload in _contents(batches, folder):
            out = out or _Writer(target, level, file_bytes)
            out.add({n: row[n] for n in _NAMES}, payload if row["kind"] == "response" else None)
            if len(out.rows) == 4096:
                yield out.headers()
        if out is not None:
            yield out.headers()
            out.close()

    return cut(_parts(index).mapInArrow(copy, INDEX), "warc-index")


def read_archives(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Header rows as the archives have them, with column ``payload`` (binary) if wanted.

    Each record is read whole and the digest of each response verified.
    """
    schema = INDEX + (", payload binary" if payloads else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, data, held = [], [], 0
        for _, row, payload in _contents(batches, folder):
            rows.append(row)
            data.append(payload if payloads and row["kind"] == "response" else None)
            held += len(data[-1] or b"")
            if len(rows) == 4096 or held > 8 << 20:
                yield batch(rows, data)
                rows, data, held = [], [], 0
        if rows:
            yield batch(rows, data)

    def batch(rows: list[dict], data: list[bytes | None]) -> pa.RecordBatch:
        out = _batch(rows)
        if not payloads:
            return out
        return pa.RecordBatch.from_arrays([*out.columns, pa.array(data, pa.binary())], [*_NAMES, "payload"])

    return _parts(index).mapInArrow(read, schema)


def deduplicated_pages(pages: DataFrame, **options) -> DataFrame:
    """Pages written as archives, deduplicated, and read back: the header rows of the new archives."""
    spark = pages.sparkSession
    raw, target = workspace(spark, "warc"), workspace(spark, "warc-deduplicated")
    index = write_archives(pages, raw, **options)
    return read_archives(write_deduplicated(resolve_revisits(index), raw, target), target)
