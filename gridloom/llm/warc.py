"""Web archives: written as one gzip stream per file, then normalised to one member per record.

Tasks write WARC files in the form that many tools produce, one compressed stream over the whole file,
which cannot be entered anywhere but at its start. The normaliser inflates each stream once, writes
every record again as a gzip member of its own, and puts an index of offsets beside the file; after
that, any record is read by one seek. A file is closed at ``FILE_BYTES`` of records, so what one task
has to inflate is bounded.

All files go to the shared folder, under a name of the attempt; only those that a finished task has
reported count, so a lost or repeated task leaves nothing that is read.

Nulls and edge cases: a null payload is empty; a record without an id is a response, or a revisit
of the same payload under an id; rows that repeat id and payload are all responses if theirs is the
smallest id; a null address is left out and line breaks in one are escaped; an empty table gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut_lineage, scratch_path, shuffle_partitions, sliced, utf8
from gridloom.operators.lookup import lookup_join

#: Payloads below this size are always written in full.
LEAST_SHARED = 100
FILE_BYTES = 256 << 20
READ = 1 << 16
GZIP = 31
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:record:"
_INDEX = "path string, at long, size long, record_id string, type string"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URL, and the path in it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pafs.LocalFileSystem(),
        path,
    )


def record_bytes(row: dict) -> bytes:
    """A WARC record; a revisit has the response's header only."""
    payload, revisit = row["payload"], row["refers_to"] is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_URN}{'' if row['id'] is None else row['id']}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", row["url"].replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        fields += [("WARC-Refers-To", f"<{_URN}{row['refers_to']}>"), ("WARC-Profile", _PROFILE)]
    fields += [
        ("WARC-Payload-Digest", f"sha256:{row['digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v for k, v in (line.split(": ", 1) for line in lines if line)}


def inflated(stream) -> Iterator[bytes]:
    """What a gzip file holds, one member or several, in pieces of bounded size."""
    member = zlib.decompressobj(GZIP)
    while data := stream.read(READ):
        while data:
            yield member.decompress(data)
            data = b""
            if member.eof:
                data, member = member.unused_data, zlib.decompressobj(GZIP)


def records_in(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and bytes of each record of an inflated archive, one at a time."""
    held, at = bytearray(), 0
    whole, need, fields = 0, 0, None
    for piece in pieces:
        held += piece
        while True:
            if fields is None:
                end = held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                fields = header_fields(bytes(held[at:end]))
                need = end + 4 + int(fields["content-length"]) + 4 - at
            if len(held) - at < need:
                break
            yield fields, bytes(held[at : at + need])
            at, fields, whole = at + need, None, whole + 1
        if at:
            del held[:at]
            at = 0
    if held:
        raise ValueError(f"the archive ends inside a record, after {whole} whole ones")


def _own_name(folder: str, number: int) -> str:
    task = TaskContext.get()
    return f"{folder}/{task.partitionId():06d}-{number:04d}-{uuid.uuid4().hex}.warc.gz"


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write records (id, url, payload, digest, refers_to) as monolithic archives: path, records."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        done: list[tuple[str, int]] = []
        out = packer = None
        size = number = 0

        def close() -> None:
            out.write(packer.flush())
            out.close()

        for batch in sliced(batches):
            for row in batch.to_pylist():
                if out is None:
                    name, number = _own_name(root, len(done)), 0
                    out = store.open_output_stream(name, compression=None)
                    packer, size = zlib.compressobj(1, 8, GZIP), 0
                data = record_bytes(row)
                out.write(packer.compress(data))
                size, number = size + len(data), number + 1
                if size >= file_bytes:
                    close()
                    done.append((posixpath.basename(name), number))
                    out = None
        if out is not None:
            close()
            done.append((posixpath.basename(name), number))
        yield pa.RecordBatch.from_pydict(
            {
                "path": pa.array([f"{folder}/{n}" for n, _ in done], pa.string()),
                "records": pa.array([k for _, k in done], pa.int64()),
            }
        )

    return cut_lineage(records.mapInArrow(write, "path string, records long"), "archives")


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Each record of each archive as a gzip member of its own; the index of all of them.

    Beside every new file lies its index, a line of JSON per record (``.idx``).
    """

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        number = 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                name, number = _own_name(root, number), number + 1
                base = posixpath.basename(name)
                entries: list[tuple] = []
                at = 0
                old_store, old = filesystem(path)
                side = store.open_output_stream(f"{name}.idx", compression=None)
                with (
                    old_store.open_input_stream(old, compression=None) as stream,
                    store.open_output_stream(name, compression=None) as out,
                ):
                    for fields, data in records_in(inflated(stream)):
                        packer = zlib.compressobj(6, 8, GZIP)
                        member = packer.compress(data) + packer.flush()
                        out.write(member)
                        ident = fields["warc-record-id"]
                        entry = (f"{folder}/{base}", at, len(member), ident, fields["warc-type"])
                        side.write((json.dumps(entry[1:]) + "\n").encode())
                        entries.append(entry)
                        at += len(member)
                        if len(entries) == 1000:
                            yield _index_batch(entries)
                            entries = []
                side.close()
                yield _index_batch(entries)

    # One file is one task's work, as its stream has no other entry.
    files = archives.select("path").repartition(shuffle_partitions(archives.sparkSession), "path")
    return cut_lineage(files.mapInArrow(normalise, _INDEX), "index")


def _index_batch(entries: list[tuple]) -> pa.RecordBatch:
    names = ["path", "at", "size", "record_id", "type"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns = list(zip(*entries, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def _id_of(urn: str | None) -> str | None:
    text = urn[1:-1].removeprefix(_URN) if urn else ""
    return text or None


def read_records(index: DataFrame) -> DataFrame:
    """The records the index names, each read by itself: id, type, refers_to, url, payload_bytes,
    payload_digest and, of responses, the payload. Raises where a payload differs from its digest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, stream = None, None
        for batch in sliced(batches, 200):
            rows = []
            for entry in batch.to_pylist():
                if entry["path"] != path:
                    if stream is not None:
                        stream.close()
                    path = entry["path"]
                    store, name = filesystem(path)
                    stream = store.open_input_file(name)
                data = zlib.decompress(stream.read_at(entry["size"], entry["at"]), GZIP)
                head, rest = data[:-4].split(b"\r\n\r\n", 1)
                fields = header_fields(head)
                http, payload = rest.split(b"\r\n\r\n", 1)
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                size = int(header_fields(http)["content-length"])
                revisit = fields["warc-type"] == "revisit"
                if not revisit and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
                    raise ValueError(f"{fields['warc-record-id']} in {path}: payload differs")
                rows.append(
                    (
                        _id_of(fields["warc-record-id"]),
                        fields["warc-type"],
                        _id_of(fields.get("warc-refers-to")),
                        fields.get("warc-target-uri"),
                        size,
                        digest,
                        None if revisit else payload,
                    )
                )
            names = ["id", "type", "refers_to", "url", "payload_bytes", "payload_digest", "payload"]
            kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )
        if stream is not None:
            stream.close()

    schema = (
        "id string, type string, refers_to string, url string, payload_bytes long, "
        "payload_digest string, payload binary"
    )
    return index.mapInArrow(read, schema)


def records_of(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """id, url, payload, digest and, for a later copy of a payload, refers_to (else null)."""
    data = utf8(F.col(f"`{payload_col}`"))
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        data.alias("payload"),
        F.sha2(data, 256).alias("digest"),
    )
    large = rows.where(F.octet_length("payload") >= LEAST_SHARED).select("digest", "id")
    first = large.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    first = cut_lineage(first.where("n > 1").select("digest", "first"), "copies")
    rows = lookup_join(rows, first, ["digest"], ["id"])
    other = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return rows.select("id", "url", "payload", "digest", F.when(other, F.col("first")).alias("refers_to"))


def archive_pages(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """Write, normalise and index the pages; the index of the normalised archives."""
    spark = df.sparkSession
    records = records_of(df, id_col, url_col, payload_col)
    records = records.withColumns({c: F.col(c).cast("string") for c in ("id", "refers_to")})
    archives = write_archives(records, scratch_path(spark, "warc"))
    return normalise_archives(archives, scratch_path(spark, "warc-members"))
