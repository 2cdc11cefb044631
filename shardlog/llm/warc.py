"""WARC archives: write, normalise to one gzip member per record, and read back.

Payloads that repeat are written once: the record of the smallest id is a response,
the others revisit it. The writer leaves monolithic archives, each one gzip stream.
The normaliser inflates such a stream once, from front to back, writes every record
as its own member and the members' offsets to a sidecar file; readers go by that.

Archives lie in the shared folder. Names are new for every attempt of a task and
count only once a manifest row names them, so a task may be lost or run twice.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardlog.llm.common import byte_blocks, narrow
from shardlog.session import scratch_path, store

# Payloads of fewer bytes are always written out.
LEAST_REVISITED = 100
# Payload of one archive, or one record.
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20
LEVEL = 4
DATE = "2000-01-01T00:00:00Z"
_GZIP = 31  # zlib's window bits for a gzip header and trailer


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


# The id of a record whose page has none.
_NO_PAGE = "<urn:x-no-page>"


def _urn(page: str | None) -> str:
    return _NO_PAGE if page is None else f"<urn:x-page:{quote(page, safe='')}>"


def encode_record(record_id: str | None, url: str | None, payload: bytes, n_bytes: int, digest: str, refers_to: str | None, date: str = DATE) -> bytes:
    """One WARC record. A revisit holds the HTTP headers of the full payload only. Ids
    are percent-escaped, so that any text may be one, an empty one too."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(record_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _page(urn: str | None) -> str | None:
    return None if urn in (None, _NO_PAGE) else unquote(re.sub(r"^<urn:x-page:(.*)>$", r"\1", urn))


def decode_record(record: bytes) -> dict:
    """Id, type, payload facts and reference of a record; a response's payload is
    digested anew and must be what its headers say."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = headers_of(head)
    block = block[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    n_bytes = int(headers_of(http)["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if fields["warc-type"] == "response" and (len(payload) != n_bytes or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of record {fields['warc-record-id']} is not what its headers say")
    return {
        "id": _page(fields["warc-record-id"]),
        "payload_bytes": n_bytes,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload": payload if fields["warc-type"] == "response" else None,
    }


def inflated(chunks: Iterator[bytes], name: str) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in bounded pieces."""
    stream, inside = zlib.decompressobj(_GZIP), False
    for chunk in chunks:
        full = False
        while chunk or full:
            piece = stream.decompress(chunk, READ_BYTES)
            yield piece
            inside, full = True, len(piece) == READ_BYTES
            chunk = stream.unconsumed_tail
            if stream.eof:
                chunk, inside, full = stream.unused_data, False, False
                stream = zlib.decompressobj(_GZIP)
    if inside:
        raise ValueError(f"{name} ends inside a gzip member")


def records_of(chunks: Iterator[bytes], name: str) -> Iterator[bytes]:
    """Whole records from inflated chunks; one record at a time is held."""
    held, need = bytearray(), 0
    for chunk in chunks:
        held += chunk
        while len(held) >= max(need, 1):
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                if not held.startswith(b"WARC/"):
                    raise ValueError(f"{name} has no record where one should begin")
                need = end + 4 + int(headers_of(bytes(held[:end]))["content-length"]) + 4
                continue
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError(f"{name} ends inside a record")


def _chunks(file) -> Iterator[bytes]:
    while chunk := file.read(READ_BYTES):
        yield chunk


def plan_records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISITED) -> DataFrame:
    """(id, url, payload, n_bytes, digest, refers_to) per page: refers_to is the
    smallest id of an equal payload, null where the payload is written out."""
    rows = narrow(pages, id=id_col, url=url_col, html=html_col).select(
        "id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload")
    )
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha2("payload", 256).alias("digest"))
    # Counted per digest before the shuffle, and written down, so that the join with
    # the payloads has its own shuffle, which can be split where a payload is hot.
    firsts = store(
        rows.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "payloads"
    )
    refers = F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first"))
    return rows.join(firsts, "digest", "left").select("id", "url", "payload", "n_bytes", "digest", refers.alias("refers_to"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Monolithic gzip archives of planned records, as a manifest (path)."""

    def run(batches):
        files, folder_path = open_folder(folder)
        files.create_dir(folder_path, recursive=True)
        out, size, path, deflate, done = None, 0, "", None, []
        for batch in byte_blocks(batches, "payload", READ_BYTES):
            for r in batch.to_pylist():
                if out is None:
                    path, size, deflate = f"{folder_path}/{uuid.uuid4().hex}.warc.gz", 0, zlib.compressobj(LEVEL, wbits=_GZIP)
                    out = files.open_output_stream(path, compression=None)
                refers = None if r["refers_to"] is None else str(r["refers_to"])
                record_id = None if r["id"] is None else str(r["id"])
                out.write(deflate.compress(encode_record(record_id, r["url"], r["payload"], r["n_bytes"], r["digest"], refers)))
                size += len(r["payload"])
                if size >= archive_bytes:
                    out.write(deflate.flush())
                    out.close()
                    out = None
                    done.append(path)
        if out is not None:
            out.write(deflate.flush())
            out.close()
            done.append(path)
        yield pa.RecordBatch.from_pydict({"path": pa.array(done, pa.string())})

    return store(records.mapInArrow(run, "path string"), "archives")


def _one_task_each(manifest: DataFrame) -> DataFrame:
    """Archives over tasks: reading one takes far longer than its row."""
    return manifest.repartition(max(1, manifest.count()), "path")


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """Archives with one gzip member per record, each with a sidecar index of offset,
    length, id and type, as a manifest (path, index, n_records)."""

    def run(batches):
        files, folder_path = open_folder(folder)
        files.create_dir(folder_path, recursive=True)
        rows = []
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            target = f"{folder_path}/{uuid.uuid4().hex}.warc.gz"
            offset, n = 0, 0
            with (
                files.open_input_stream(path, compression=None) as source,
                files.open_output_stream(target, compression=None) as out,
                files.open_output_stream(f"{target}.idx", compression=None) as index,
            ):
                for record in records_of(inflated(_chunks(source), path), path):
                    packer = zlib.compressobj(LEVEL, wbits=_GZIP)
                    member = packer.compress(record) + packer.flush()
                    out.write(member)
                    fields = headers_of(record.partition(b"\r\n\r\n")[0])
                    entry = {"offset": offset, "length": len(member), "id": fields["warc-record-id"], "type": fields["warc-type"]}
                    index.write(json.dumps(entry).encode() + b"\n")
                    offset += len(member)
                    n += 1
            rows.append({"path": target, "index": f"{target}.idx", "n_records": n})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("index", pa.string()), ("n_records", pa.int64())]))

    return store(_one_task_each(manifest).mapInArrow(run, "path string, index string, n_records long"), "normalised")


RECORD = "id string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"
_RECORD_TYPES = pa.schema(
    [("id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())]
)


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of normalised archives, each read at its offset in the index."""
    schema = _RECORD_TYPES.append(pa.field("payload", pa.binary())) if with_payload else _RECORD_TYPES

    def run(batches):
        files, _ = open_folder(folder)
        for path, index in ((r["path"], r["index"]) for b in batches for r in b.to_pylist()):
            with files.open_input_file(path) as archive, files.open_input_stream(index, compression=None) as lines:
                rows, size = [], 0
                for line in lines.read().splitlines():
                    entry = json.loads(line)
                    archive.seek(entry["offset"])
                    record = zlib.decompress(archive.read(entry["length"]), wbits=_GZIP)
                    rows.append({k: v for k, v in decode_record(record).items() if with_payload or k != "payload"})
                    size += len(record)
                    if size > READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return _one_task_each(manifest).mapInArrow(run, RECORD if with_payload else RECORD.removesuffix(", payload binary"))


def round_trip(pages: DataFrame, *, id_col: str = "page_id", with_payload: bool = False, **options) -> DataFrame:
    """Pages through monolithic and normalised archives and back: (id, payload_bytes,
    payload_digest, record_type, refers_to), ids in the type they came in.

    A null html is an empty payload, a null url an empty target. A null id stays null;
    it is nobody's response unless all equal payloads have none. Rows that repeat the
    smallest id of a payload are all responses. Without pages there are no archives.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    archives = write_archives(plan_records(pages, id_col=id_col, **options), f"{folder}/monolithic")
    read = read_archives(normalise(archives, f"{folder}/members"), folder, with_payload)
    kind = narrow(pages, id=id_col).schema["id"].dataType
    return read.withColumn("id", F.col("id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))
