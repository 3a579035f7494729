"""WARC archives: writing monolithic gzip files, normalising them to a member per record, reading by index."""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import Scratch, texts
from quayside.operators.joins import skew_join
from quayside.session import remove_path

CHUNK = 1 << 20
END = b"\r\n\r\n"  # fixed value: ends a header and a record


def file_system(path: str):
    """The store of a shared path and the path in it: whatever pyarrow opens, local or remote.

    Hadoop's names of object stores are those of pyarrow with a letter more.
    """
    from pyarrow import fs

    scheme, mark, rest = path.partition("://")
    path = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}.get(scheme, scheme) + mark + rest
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_head(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The header of a response, or of a revisit if `refers_to` is given, without its payload.

    A page without an id has a record id of its own.
    """
    name = f"urn:uuid:{uuid.uuid4()}" if page_id is None else f"urn:page:{page_id}"
    kind = "response" if refers_to is None else "revisit"
    lines = [
        b"WARC/1.1",
        b"WARC-Type: " + kind.encode(),
        f"WARC-Record-ID: <{name}>".encode(),
        b"WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}".encode(),
        # An extension field: a revisit has no payload but states the size of the one it stands for.
        f"Payload-Length: {len(payload)}".encode(),
        b"Content-Type: text/html",
        f"Content-Length: {len(payload) if refers_to is None else 0}".encode(),
    ]
    if url is not None:
        # A line break in a url would end the field.
        lines.append(b"WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").encode())
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>".encode())
        lines.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return b"\r\n".join(lines) + END


FILES = "path string, records bigint, bytes bigint"


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 256_000_000) -> DataFrame:
    """Write `pages` (page_id, url, html, refers_to) as monolithic gzip archives; lists the files.

    Each task streams its rows into files that are a single gzip member each, and begins another file
    after `archive_bytes` of records. Files get names of their own in `folder`, so a task that
    runs again, or twice, leaves files that the list does not name.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        store.create_dir(root, recursive=True)
        out = packer = None
        name, records, size = "", 0, 0

        def close() -> pa.RecordBatch:
            out.write(packer.flush())
            out.close()
            return _row(FILES, name, records, size)

        for batch in batches:
            pages_of = zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)),
                batch.column(3).to_pylist(), strict=True,
            )
            for page, url, html, refers_to in pages_of:
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                payload = html or b""
                head = record_head(page, url, payload, base32_sha1(payload), refers_to)
                body = payload if refers_to is None else b""
                for part in (head, body, END):
                    out.write(packer.compress(part))
                records, size = records + 1, size + len(head) + len(body) + len(END)
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    chosen = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"),
        F.col("refers_to").cast("bigint"),
    )
    return chosen.mapInArrow(write, FILES)


def _row(schema: str, *values) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array([v], kinds[kind]) for v, (_, kind) in zip(values, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of a gzip stream of one or more members, in bounded pieces."""
    unpacker = zlib.decompressobj(31)
    begun = False
    for chunk in chunks:
        while chunk:
            begun = True
            piece = unpacker.decompress(chunk, CHUNK)
            if piece:
                yield piece
            if unpacker.eof:
                chunk, begun = unpacker.unused_data, False
                unpacker = zlib.decompressobj(31)
            else:
                chunk = unpacker.unconsumed_tail
    if begun:
        raise ValueError("the archive ends within a gzip member")


def record_parts(pieces: Iterator[bytes]) -> Iterator[tuple[bytes | None, bytes]]:
    """Records of an inflated WARC stream as (header, b"") followed by (None, part of the content) ones.

    No record is held whole: only a header and one piece at a time.
    """
    held = b""
    pieces = iter(pieces)
    while True:
        while END not in held:
            piece = next(pieces, None)
            if piece is None:
                if held.strip():
                    raise ValueError("the archive ends within a record header")
                return
            held = (held + piece).lstrip(b"\r\n") if not held else held + piece
        head, _, held = held.partition(END)
        length = header_fields(head).get("content-length")
        if not head.startswith(b"WARC/") or length is None:
            raise ValueError("not a WARC record header")
        yield head + END, b""
        left = int(length) + len(END)
        while left:
            if not held:
                held = next(pieces, b"")
                if not held:
                    raise ValueError("the archive ends within a record")
            part, held = held[:left], held[left:]
            left -= len(part)
            yield None, part


def header_fields(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


INDEX = "path string, offset bigint, size bigint, record_id string"


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite archives (path below `source`) with a gzip member per record; returns the index.

    A gzip stream can only be read from its start, so each archive is one task's work, whatever its
    size: it is inflated once, record by record, and each record is written as a member of its own as
    it streams by. Beside `name.warc.gz` a sidecar `name.idx` lists offset, size and record id of
    every member as JSON lines. Output names are new for each attempt; the returned index names
    those of the attempt that counted. Archives of several members, or with records of any
    size, are read alike; one that breaks off raises an error.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(source)
        out_store, out_root = file_system(target)
        out_store.create_dir(out_root, recursive=True)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fresh = f"{name.split('.')[0]}-{uuid.uuid4().hex}"
                rows = []
                with (
                    store.open_input_stream(f"{root}/{name}", compression=None) as stream,
                    out_store.open_output_stream(f"{out_root}/{fresh}.warc.gz", compression=None) as out,
                ):
                    chunks = iter(lambda stream=stream: stream.read(CHUNK), b"")
                    offset, packer, size, record = 0, None, 0, ""
                    for head, part in record_parts(inflate(chunks)):
                        if head is not None:
                            if packer is not None:
                                size += out.write(packer.flush())
                                rows.append((f"{fresh}.warc.gz", offset, size, record))
                                offset += size
                            packer, size = zlib.compressobj(6, zlib.DEFLATED, 31), 0
                            record = header_fields(head).get("warc-record-id", "")
                            part = head
                        size += out.write(packer.compress(part))
                    if packer is not None:
                        size += out.write(packer.flush())
                        rows.append((f"{fresh}.warc.gz", offset, size, record))
                with out_store.open_output_stream(f"{out_root}/{fresh}.idx", compression=None) as sidecar:
                    for row in rows:
                        sidecar.write(json.dumps(dict(zip(("offset", "size", "record_id"), row[1:], strict=True))).encode() + b"\n")
                for at in range(0, len(rows), 10_000):
                    columns = zip(*rows[at : at + 10_000], strict=True)
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                        [f.split()[0] for f in INDEX.split(", ")],
                    )

    return archives.select("path").mapInArrow(rewrite, INDEX)


READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, payload binary"


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Records at the places that `index` names: type, digest, size and payload (null for a revisit).

    Each member is inflated alone. A response whose payload does not have the digest or length its
    header states raises an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        opened, stream = None, None
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = [f.split()[0] for f in READ.split(", ")]
        for batch in batches:
            rows, held = [], 0
            for path, offset, size in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if path != opened:
                    if stream is not None:
                        stream.close()
                    opened, stream = path, store.open_input_file(f"{root}/{path}")
                content = zlib.decompress(stream.read_at(size, offset), 31)
                head, _, rest = content.partition(END)
                fields = header_fields(head)
                name = fields["warc-record-id"].strip("<>")
                page = int(name.removeprefix("urn:page:")) if name.startswith("urn:page:") else None
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                refers = fields.get("warc-refers-to")
                payload = None
                if refers is None:
                    payload = rest[: int(fields["content-length"])]
                    if base32_sha1(payload) != digest or len(payload) != int(fields["payload-length"]):
                        raise ValueError(f"record {name} of {path} does not hold what its header states")
                to = int(refers.removeprefix("<urn:page:").removesuffix(">")) if refers else None
                rows.append((page, int(fields["payload-length"]), digest, fields["warc-type"], to, fields.get("warc-target-uri"), payload))
                held += len(payload or b"")
                if held > 8_000_000:
                    yield _records(rows, kinds, names)
                    rows, held = [], 0
            if rows:
                yield _records(rows, kinds, names)
        if stream is not None:
            stream.close()

    return index.select("path", "offset", "size").mapInArrow(read, READ)


def _records(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """`pages` (page_id, url, html) with refers_to: the largest page_id with the same payload, where that is another one.

    Rows are told by their payload, not their id: a page_id with several payloads is a revisit with one and a
    response with another. Payloads under `least_bytes`, and rows without page_id, are never revisits, nor are repeated rows of
    the largest page_id. Payloads are counted before the shuffle, and a payload that a third of all pages share is
    split over tasks.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    # Only payloads that may be referred to have a digest here; the others meet nothing.
    digest = F.when(F.col("page_id").isNotNull() & (F.length(payload) >= least_bytes), F.sha2(payload, 256))
    keyed = pages.select("page_id", "url", "html").withColumn("_digest", digest)
    best = keyed.where("_digest IS NOT NULL").groupBy("_digest").agg(F.max("page_id").alias("_last"), F.min("page_id").alias("_first"))
    best = best.where("_last > _first").select("_digest", "_last")
    found = skew_join(keyed, best, "_digest", "left")
    return found.select("page_id", "url", "html", F.when(F.col("page_id") < F.col("_last"), F.col("_last")).alias("refers_to"))


def archived(
    spark: SparkSession, pages: DataFrame, scratch: Scratch, least_bytes: int = 0, archive_bytes: int = 256_000_000
) -> DataFrame:
    """Write `pages` (page_id, url, html) as WARC archives, normalise them and read all records back.

    Of equal payloads of at least `least_bytes` the largest page_id is the response and the others
    refer to it. Null html: an empty payload. Null url: no target field. Repeated rows: a record
    each. Null page_id: a response under a record id of its own, read back as null. An empty table gives no
    archives and no rows. Other columns are ignored.
    """
    marked = with_revisits(pages.withColumn("page_id", F.col("page_id").cast("bigint")), least_bytes)
    raw, ready = scratch.path(), scratch.path()
    files = scratch.keep(write_archives(marked, raw, archive_bytes))
    # One archive per task: the list is short, and each entry is a whole file's work.
    count = max(1, files.count())
    index = scratch.keep(normalise(files.repartition(min(count, 10_000), "path"), raw, ready))
    remove_path(spark, raw)
    dealt = index.repartition(min(count, 10_000), "path").sortWithinPartitions("path", "offset")
    return read_records(dealt, ready)
