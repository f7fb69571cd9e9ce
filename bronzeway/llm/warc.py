"""WARC archives: writing, normalising whole-file gzip, reading by offset.

A crawler may compress an archive as one gzip stream, in which no record can be
reached without inflating all before it. The normaliser inflates such a stream
once, piece by piece, rewrites every record as a gzip member of its own, and
makes a sidecar index of their offsets, by which single records are then read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Payloads from this size on are stored once; others refer to that record.
LEAST_REVISIT = 1000
#: Raw bytes of an archive: a new one begins with the record that would exceed them.
ARCHIVE_BYTES = 4 << 20
GZIP_LEVEL = 5
CRAWLED = "2024-01-01T00:00:00Z"
GZIP = 31  # zlib's window setting for a gzip header
CHUNK = 1 << 16
END = b"\r\n\r\n"

ARCHIVES = "archive string, data binary"
ENTRY_TYPE = "struct<offset: bigint, length: bigint, record_type: string, page_id: bigint>"
NORMALISED = f"{ARCHIVES}, entries array<{ENTRY_TYPE}>"
RECORDS = (
    "page_id bigint, url string, record_type string, refers_to bigint,"
    " payload_bytes bigint, payload_digest string, payload binary"
)


def plan_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, response_id) of every row.

    The payload is the html in UTF-8, empty for NULL. Of equal payloads of at
    least ``least`` bytes the row with the largest page_id (NULL is smaller than
    all) is the response, and ``response_id`` names it on every row of the group;
    rows that repeat this page_id are responses too. Shorter ones have none.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    large = rows.filter(F.octet_length("payload") >= least)
    firsts = large.groupBy("digest").agg(
        F.max("page_id").alias("response_id"), F.count("*").alias("copies")
    )
    shared = firsts.filter("copies > 1").select("digest", "response_id")
    return rows.join(shared, "digest", "left")


def _field(name: str, value) -> bytes:
    """A header line; control characters and % in the value are escaped."""
    text = str(value)
    safe = "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "%\x7f" else c for c in text)
    return f"{name}: {safe}\r\n".encode()


def _plain(value: bytes) -> str:
    out, at = bytearray(), 0
    while (cut := value.find(b"%", at)) >= 0:
        out += value[at:cut] + bytes([int(value[cut + 1 : cut + 3], 16)])
        at = cut + 3
    return (out + value[at:]).decode()


def record_bytes(page_id, url, payload: bytes, digest: str, response_id) -> bytes:
    revisit = response_id is not None and response_id != page_id
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + _field("Content-Length", len(payload)) + b"\r\n"
    block += b"" if revisit else payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {digest}")
    head = b"WARC/1.1\r\n" + _field("WARC-Type", "revisit" if revisit else "response")
    head += _field("WARC-Record-ID", f"<urn:uuid:{name}>") + _field("WARC-Date", CRAWLED)
    if url is not None:
        head += _field("WARC-Target-URI", url)
    if page_id is not None:
        head += _field("WARC-Page-ID", page_id)
    if revisit:
        head += _field(
            "WARC-Profile",
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ) + _field("WARC-Refers-To-Page-ID", response_id)
    coded = base64.b32encode(bytes.fromhex(digest)).decode()
    head += _field("WARC-Payload-Digest", f"sha1:{coded}")
    head += _field("Content-Type", "application/http; msgtype=response")
    head += _field("Content-Length", len(block))
    return head + b"\r\n" + block + END


def _archive(records: list[bytes]) -> tuple[str, bytes]:
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, GZIP)
    data = b"".join([packer.compress(r) for r in records]) + packer.flush()
    return f"{hashlib.sha1(data).hexdigest()}.warc.gz", data


def write_monolithic(records: DataFrame, size: int = ARCHIVE_BYTES) -> DataFrame:
    """Rows of ``plan_records`` as (archive, data): archives of one gzip stream each.

    The name is a digest of the content, so a task that runs twice makes the
    same archives. No rows make no archive.
    """

    def run(batches):
        kept, n = [], 0
        for batch in batches:
            values = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "response_id")]
            done = []
            for row in zip(*values):
                record = record_bytes(*row)
                if kept and n + len(record) > size:
                    done.append(_archive(kept))
                    kept, n = [], 0
                kept.append(record)
                n += len(record)
            if done:
                yield _rows(done)
        if kept:
            yield _rows([_archive(kept)])

    return records.select("page_id", "url", "payload", "digest", "response_id").mapInArrow(run, ARCHIVES)


def _rows(archives: list[tuple[str, bytes]]) -> pa.RecordBatch:
    names, data = zip(*archives)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(data, pa.binary())], names=["archive", "data"]
    )


def inflate(data: bytes) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in pieces."""
    source = memoryview(data)
    unpacker, at = zlib.decompressobj(GZIP), 0
    while at < len(source) or unpacker.unconsumed_tail:
        given = unpacker.unconsumed_tail or source[at : at + CHUNK]
        at += 0 if unpacker.unconsumed_tail else len(given)
        yield unpacker.decompress(given, CHUNK)
        while unpacker.eof and (unpacker.unused_data or at < len(source)):
            rest = unpacker.unused_data or bytes(source[at : at + CHUNK])
            at += 0 if unpacker.unused_data else len(rest)
            unpacker = zlib.decompressobj(GZIP)
            yield unpacker.decompress(rest, CHUNK)
        if unpacker.eof:
            return
    yield unpacker.flush()


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream; holds no more than one and a piece."""
    held, missing = bytearray(), 0
    for piece in pieces:
        held += piece
        while len(held) >= missing:
            head = held.find(END)
            if head < 0:
                break
            fields = parse_fields(bytes(held[:head]))
            missing = head + 4 + int(fields[b"content-length"]) + 4
            if len(held) < missing:
                break
            yield bytes(held[:missing])
            del held[:missing]
            missing = 0
    if held:
        raise ValueError("the archive ends inside a record")


def parse_fields(head: bytes) -> dict[bytes, bytes]:
    pairs = (line.partition(b": ") for line in head.split(b"\r\n")[1:])
    return {name.lower(): value for name, _, value in pairs}


def _number(value: bytes | None) -> int | None:
    return None if value is None else int(value)


def parse_record(record: bytes) -> dict:
    """A record's fields; digest and size are recomputed where the payload is there."""
    cut = record.index(END)
    fields = parse_fields(record[:cut])
    block = record[cut + 4 : cut + 4 + int(fields[b"content-length"])]
    http, payload = block.split(END, 1)
    kind = fields[b"warc-type"].decode()
    stated = base64.b32decode(fields[b"warc-payload-digest"].split(b":")[1]).hex()
    size = int(parse_fields(http)[b"content-length"])
    if kind == "response":
        digest = hashlib.sha1(payload).hexdigest()
        if (digest, len(payload)) != (stated, size):
            raise ValueError(f"a payload doesn't match its digest {stated}")
    url = fields.get(b"warc-target-uri")
    return {
        "page_id": _number(fields.get(b"warc-page-id")),
        "url": None if url is None else _plain(url),
        "record_type": kind,
        "refers_to": _number(fields.get(b"warc-refers-to-page-id")),
        "payload_bytes": size,
        "payload_digest": stated,
        "payload": payload if kind == "response" else None,
    }


def normalise_archive(data: bytes) -> tuple[bytes, list[dict]]:
    """(archive with a member per record, entries of its offset index)."""
    out, entries = io.BytesIO(), []
    for record in split_records(inflate(data)):
        packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, GZIP)
        start = out.tell()
        out.write(packer.compress(record) + packer.flush())
        fields = parse_fields(record[: record.index(END)])
        entries.append(
            {
                "offset": start,
                "length": out.tell() - start,
                "record_type": fields[b"warc-type"].decode(),
                "page_id": _number(fields.get(b"warc-page-id")),
            }
        )
    return out.getvalue(), entries


_ENTRY = pa.list_(
    pa.struct(
        [("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64())]
    )
)


def normalise(archives: DataFrame) -> DataFrame:
    """(archive, data, entries): each archive rewritten, with its index.

    Takes archives of one or many members. An empty archive stays empty and has
    no entries; a NULL one counts as empty; one that ends inside a record, or
    isn't gzip, is an error.
    """

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column("archive").to_pylist(), batch.column("data").to_pylist()):
                made, entries = normalise_archive(data or b"")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([made], pa.binary()), pa.array([entries], _ENTRY)],
                    names=["archive", "data", "entries"],
                )

    return archives.select("archive", "data").mapInArrow(run, NORMALISED)


def offset_index(normalised: DataFrame) -> DataFrame:
    """The sidecar index as rows: archive, offset, length, record_type, page_id."""
    return normalised.select("archive", F.inline("entries"))


def read_records(normalised: DataFrame, payload: bool = True) -> DataFrame:
    """Every record, found by its offset and inflated alone."""
    wanted = RECORDS if payload else RECORDS.rpartition(",")[0]
    names = [f.split()[0] for f in wanted.split(",")]
    kinds = {"payload": pa.binary(), "url": pa.string(), "record_type": pa.string(), "payload_digest": pa.string()}
    schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in names])

    def run(batches):
        for batch in batches:
            for data, entries in zip(batch.column("data").to_pylist(), batch.column("entries").to_pylist()):
                rows = []
                for e in entries:
                    member = data[e["offset"] : e["offset"] + e["length"]]
                    row = parse_record(zlib.decompress(member, GZIP))
                    rows.append({n: row[n] for n in names})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return normalised.select("data", "entries").mapInArrow(run, wanted)


def export_files(normalised: DataFrame, folder: str) -> DataFrame:
    """Archives and their indexes as files in a shared folder; returns their paths.

    ``folder`` is a URI that pyarrow knows, or a path. A file gets its name when
    it is complete; names are digests, so a task that runs again rewrites the same.
    """

    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for name, data, entries in zip(*(batch.column(c).to_pylist() for c in ("archive", "data", "entries"))):
                index = "".join(json.dumps(e) + "\n" for e in entries).encode()
                for file, content in ((name, data), (f"{name}.idx", index)):
                    part = f"{base}/.{file}.{uuid.uuid4().hex}"
                    with store.open_output_stream(part) as out:
                        out.write(content)
                    store.move(part, f"{base}/{file}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{base}/{name}"]), pa.array([len(entries)], pa.int64())], names=["path", "records"]
                )

    return normalised.mapInArrow(run, "path string, records bigint")
