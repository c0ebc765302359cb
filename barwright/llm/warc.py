"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: each task trains a dictionary on the first records of an archive, puts it into a skippable frame
and appends one frame per record. Archives have the name of their partition and number, and rows are
sorted inside a partition, so a task that runs again replaces its files by equal ones; a file appears
under its name only when it is whole.

Reading: archives are loaded as binary files. The dictionary is taken from the skippable frame, frames are
walked one by one, and every record is checked: the version line, the named headers it must have, the
content length against the block, the closing line breaks, and, where the payload is there, its digest.

A null html is an empty payload; a null url leaves out the target header and control characters in a url
are percent-encoded. Among records of equal payloads, repeated rows of the smallest page_id are all
responses; a null page_id counts as larger than all others. An empty table writes no record. Columns
beside page_id, url and html are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.sources.staging import stage

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D  # the skippable frame that holds a dictionary
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An archive is closed at so many compressed bytes, so that a reader can hold it.
ARCHIVE_BYTES = 32 << 20
#: A dictionary is trained on at most so many bytes of an archive's first records.
TRAINING_BYTES = 2 << 20
DICTIONARY_BYTES = 32 << 10
FRAME_STEP = 1 << 14


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None, date: str, size: int | None = None) -> bytes:
    """One record: a response with its payload, or a revisit with only the HTTP head (and the payload's ``size``)."""
    size = len(payload) if size is None else size
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m.group()), url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{payload_digest}"))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", SAME_PAYLOAD)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Check a record and give its fields; raises ValueError with the reason."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise ValueError("no WARC version line or no end of the headers")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#-'*+.0-9A-Z^-z|~-]+", name):
            raise ValueError(f"malformed header {line[:80]!r}")
        fields.setdefault(name.decode().lower(), value.strip().decode())
    if lost := [n for n in NEEDED if n not in fields]:
        raise ValueError(f"headers missing: {lost}")
    if not fields["content-length"].isdigit() or int(fields["content-length"]) != len(rest) - 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("the content length differs from the block, or the record does not close")
    block = rest[:-4]
    http, gap, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    kind = fields["warc-type"]
    if kind not in ("response", "revisit") or not gap or size is None:
        raise ValueError(f"a {kind} record without an HTTP head and length")
    algorithm, _, value = fields.get("warc-payload-digest", "").partition(":")
    if algorithm != "sha1" or not value:
        raise ValueError("no sha1 payload digest")
    if kind == "response" and (int(size[1]) != len(payload) or digest(payload) != value):
        raise ValueError("the payload differs from its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("a revisit with a payload, or that refers to nothing")
    return {
        "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload_bytes": int(size[1]),
        "payload_digest": value, "record_type": kind, "refers_to": _page(fields.get("warc-refers-to", "")),
        "payload": payload if kind == "response" else None,
    }


def _page(uri: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d*)>", uri)
    return int(m[1]) if m and m[1] else None


def _dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on the samples; empty if they are too few to train one."""
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples, level=3, threads=0).as_bytes()
    except zstd.ZstdError:
        return b""


def write_archive(records: Iterable[bytes], out: io.RawIOBase, most_bytes: int = ARCHIVE_BYTES) -> tuple[int, int, bool]:
    """Write records until the archive is full; (records, bytes, whether some may be left)."""
    records = iter(records)
    first, size = [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if size >= TRAINING_BYTES:
            break
    trained = _dictionary(first) if len(first) >= 8 else b""
    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(trained)) + trained)
    packer = zstd.ZstdCompressor(level=3, dict_data=zstd.ZstdCompressionDict(trained) if trained else None, write_content_size=True, write_checksum=True)
    n, written = 0, 8 + len(trained)
    for source in (first, records):
        for record in source:
            frame = packer.compress(record)
            out.write(frame)
            n, written = n + 1, written + len(frame)
            if written >= most_bytes and source is records:
                return n, written, True
    return n, written, False


def read_archive(data: bytes) -> Iterator[bytes]:
    """The record in each frame of an archive."""
    view, at, dictionary = memoryview(data), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        if len(data) < 8 + size:
            raise ValueError("the dictionary frame is cut off")
        raw = bytes(view[8 : 8 + size])
        if raw[:4] == FRAME_MAGIC:  # a dictionary may itself be compressed
            raw = zstd.ZstdDecompressor().decompress(raw)
        dictionary = zstd.ZstdCompressionDict(raw) if raw else None
        at = 8 + size
    unpacker = zstd.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0] if len(data) >= at + 8 else 0
        if magic & 0xFFFFFFF0 == 0x184D2A50:  # another skippable frame
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        frame, pieces, start = unpacker.decompressobj(), [], at
        try:
            while not frame.eof and at < len(data):  # in steps, as what follows the frame is handed back as a copy
                pieces.append(frame.decompress(view[at : at + FRAME_STEP]))
                at = min(len(data), at + FRAME_STEP)
        except zstd.ZstdError as e:
            raise ValueError(f"frame at byte {start}: {e}") from e
        if not frame.eof:
            raise ValueError(f"the frame at byte {start} is cut off")
        at -= len(frame.unused_data)
        yield b"".join(pieces)


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload (of revisits null), size, sha1 (hex), refers_to: which records are responses and which
    revisit one.

    Only payloads that occur twice are joined back, and their table is written first: it is broadcast if it is
    small, else a payload that a third of the pages have is split.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    firsts = rows.groupBy("sha1").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    firsts = stage(firsts.select("sha1", "first_id"), "first-payloads")
    size = F.octet_length("payload").cast("long")
    seen = F.col("first_id").isNotNull() & (size >= least_bytes) & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    planned = rows.join(firsts, "sha1", "left").select("page_id", "url", "payload", size.alias("size"), "sha1", F.when(seen, F.col("first_id")).alias("refers_to"))
    return planned.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))


def _write_partition(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get()
    where, base = pafs.FileSystem.from_uri(folder)
    where.create_dir(base, recursive=True)

    def records() -> Iterator[bytes]:
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(6)), strict=True):
                page_id, url, payload, size, sha1, refers_to = (x.as_py() for x in row)
                yield build_record(page_id, url, payload or b"", base64.b32encode(bytes.fromhex(sha1)).decode(), refers_to, date, size)

    todo, number = records(), 0
    while (head := next(todo, None)) is not None:
        name = f"{base}/part-{part.partitionId():06d}-{number:05d}.warc.zst"
        trial = f"{name}.{part.taskAttemptId()}.tmp"
        with where.open_output_stream(trial) as out:
            n, size, _ = write_archive(_chain(head, todo), out)
        where.move(trial, name)
        yield pa.RecordBatch.from_pydict({"archive": [name.rsplit("/", 1)[1]], "records": [n], "bytes": [size]})
        number += 1


def _chain(head: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield head
    yield from rest


def write_archives(planned: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write planned records as archives in ``folder`` (any URI that pyarrow can write) when the result,
    one row per archive, is computed. Of stores that only Hadoop knows (such as s3a) give the URI that pyarrow opens;
    Spark reads any of them back."""
    rows = planned.select("page_id", "url", "payload", "size", "sha1", "refers_to")
    dealt = rows.sortWithinPartitions("page_id", "url", "refers_to")
    return dealt.mapInArrow(lambda it: _write_partition(it, folder, date), "archive string, records long, bytes long")


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string"


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives in ``folder``, without the payloads; a bad record fails the job."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (f.split() for f in RECORD.split(", "))])
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                archive, rows = path.as_py().rsplit("/", 1)[1], []
                for i, raw in enumerate(read_archive(content.as_py())):
                    try:
                        rows.append(parse_record(raw) | {"archive": archive})
                    except ValueError as e:
                        raise ValueError(f"{archive}, record {i}: {e}") from e
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("path", "content").mapInArrow(parse, RECORD)
