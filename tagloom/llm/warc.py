"""WARC archives with a Zstandard dictionary.

An archive is a ``.warc.zst`` file: a leading skippable frame holds the (compressed) dictionary, and each record is
a frame of its own, so that any record can be read alone.  The dictionary is trained on the archive's own
records, at most ``SAMPLE_BYTES`` of them; archives hold about ``ARCHIVE_BYTES`` of payload, which bounds
the memory of a task.

Records with equal payloads of at least ``LEAST_REVISIT`` bytes are stored once: that with the largest page id is
the response, the others revisit it.  Equal payloads are found by length and SHA-1 over all pages; one payload may
make up a third of all rows.

Null html is an empty payload.  Rows with the id of the response are responses too, so repeated rows are
kept.  An empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import join_groups, utf8
from tagloom.session import stage

LEAST_REVISIT = 1000
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
LEVEL = 3
# Pages have no crawl time.
DATE = "1970-01-01T00:00:00Z"

# Fixed by the file formats.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def decided(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every page with its payload, its digest and the page it revisits, if any."""
    payload = utf8(F.col(html_col))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("sha1"),
    )
    key = F.when(F.col("payload_bytes") >= LEAST_REVISIT, F.concat_ws(":", "sha1", "payload_bytes"))
    groups = (
        rows.where(F.col("payload_bytes") >= LEAST_REVISIT)
        .groupBy(key.alias("payload_key"))
        .agg(F.max("page_id").alias("first_page"), F.count(F.lit(1)).alias("copies"))
    )
    met = join_groups(rows.withColumn("payload_key", key), stage(groups, "payloads"), "payload_key", "copies", "page_id")
    again = F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    return met.select("page_id", "url", "payload", "payload_bytes", "sha1", F.when(again, F.col("first_page")).alias("refers_to"))


def _header(fields: list[tuple[str, str]]) -> bytes:
    lines = [f"{name}: {' '.join(value.split())}" for name, value in fields]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, sha1: str, refers_to: int | None) -> bytes:
    """A response or revisit record; a revisit keeps the HTTP head but not the payload."""
    http = b"HTTP/1.1 200 OK\r\n" + _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))])
    block = http if refers_to is not None else http + payload
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url or ""),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Page-ID", "" if page_id is None else str(page_id)),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to)), ("Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + _header(fields) + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on records; with too few to train, the records themselves."""
    sample: list[bytes] = []
    held = 0
    for item in records[:: max(1, sum(map(len, records)) // SAMPLE_BYTES)]:
        if held >= SAMPLE_BYTES:
            break
        sample.append(item[: SAMPLE_BYTES - held])
        held += len(sample[-1])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(sample)[:DICTIONARY_BYTES]


def build_archive(records: list[bytes]) -> bytes:
    """Dictionary frame and one frame a record."""
    data = build_dictionary(records)
    stored = zstandard.ZstdCompressor(level=LEVEL).compress(data)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data))
    frames = [struct.pack("<II", SKIPPABLE_MAGIC, len(stored)), stored]
    return b"".join(frames + [packer.compress(r) for r in records])


def read_frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one after another."""
    view = memoryview(archive)
    at, unpacker = 0, zstandard.ZstdDecompressor()
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == SKIPPABLE_MAGIC:
        at = 8 + struct.unpack_from("<I", view, 4)[0]
        data = bytes(view[8:at])
        if len(data) >= 4 and struct.unpack_from("<I", data)[0] == FRAME_MAGIC:
            data = unpacker.decompress(data)
        unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
    while at < len(view):
        reader, parts = unpacker.decompressobj(), []
        while not reader.eof:
            if at >= len(view):
                raise ValueError("The archive ends inside a record.")
            chunk = view[at : at + (64 << 10)]
            parts.append(reader.decompress(chunk))
            at += len(chunk)
        at -= len(reader.unused_data)
        yield b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse_record(data: bytes) -> dict:
    """Type, ids, length and digest of a record; the payload's own where it is stored."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    is_revisit = fields["warc-type"] == "revisit"
    if is_revisit:
        size = int(_fields(http)["content-length"])
        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return {
        "page_id": int(fields["page-id"]) if fields["page-id"] else None,
        "url": fields["warc-target-uri"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": int(fields["refers-to-page-id"]) if is_revisit else None,
        "payload": None if is_revisit else payload,
    }


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    made = 0

    def archive(records: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([f"part-{part:06d}-{made:06d}.warc.zst"]), pa.array([len(records)], pa.int64()), pa.array([build_archive(records)], pa.binary())],
            names=["path", "records", "content"],
        )

    records: list[bytes] = []
    held = 0
    for batch in batches:
        for row in zip(*batch.columns):
            records.append(record(*[v.as_py() for v in row]))
            held += len(records[-1])
            if held >= ARCHIVE_BYTES:
                yield archive(records)
                made += 1
                records, held = [], 0
    if records:
        yield archive(records)


def write_archives(pages: DataFrame, **columns: str) -> DataFrame:
    """Archives of all pages as ``(path, records, content)``, stored in the shared folder."""
    rows = decided(pages, **columns).select("page_id", "url", "payload", "payload_bytes", "sha1", "refers_to")
    return stage(rows.mapInArrow(_write, "path string, records long, content binary"), "archives")


def _read(with_payload: bool):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[dict] = []
                for data in read_frames(content.as_py()):
                    rows.append({n: v for n, v in parse_record(data).items() if n in names})
                    if len(rows) == 1000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return run


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of archives in column ``content``, as Spark's binary file source gives them too."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return archives.select("content").mapInArrow(_read(with_payload), schema + (", payload binary" if with_payload else ""))


def save_archives(archives: DataFrame, folder: str) -> None:
    """Write each archive as a file below ``folder``, a URI of a file system that pyarrow opens."""

    def save(rows) -> None:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path)
        for row in rows:
            # The content is compressed already; by its name it would be once more.
            with system.open_output_stream(f"{path}/{row.path}", compression=None) as out:
                out.write(bytes(row.content))

    archives.select("path", "content").foreachPartition(save)
