"""WARC archives: records with revisits written from tasks, and a splittable reader.

Every record is a gzip member of its own. A reading task gets a range of bytes, looks in it for the
bytes that open a gzip member, and takes a place for a record when what follows decodes to the head of a
WARC record. From there it goes on from member to member, and owns all records that begin inside its range;
the last one may end behind it. Files can so be read by any number of tasks without an index.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.llm.common import stored
from parcelflow.llm.shared import Target, opened
from parcelflow.session import workdir

FILE_BYTES = 1 << 26
SPLIT_BYTES = 1 << 22
READ_BYTES = 1 << 20
#: Reading tasks at most for each core; beyond that a task takes several splits.
TASKS_PER_CORE = 64
LEVEL = 6
MIN_BYTES = 0
DATE = "1970-01-01T00:00:00Z"

# The opening of a gzip member, and names that the WARC format prescribes.
MEMBER = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page:"

RECORD_SCHEMA = (
    "file string, offset bigint, page_id bigint, record_type string, target_uri string, payload_bytes bigint, "
    "payload_digest string, refers_to bigint, payload binary"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _plain(uri: str) -> str:
    """A URI without white space and control characters, which would break a head."""
    return "".join(c if c.isprintable() and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in uri)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member; a revisit holds the HTTP head alone."""
    name = f"<{PAGE_URN}{'' if page_id is None else page_id}>"
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _plain(url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<{PAGE_URN}{refers_to}>")]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def _write(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, target = TaskContext.get().partitionId(), 0, None

        def closed() -> pa.RecordBatch:
            target.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([target.size], pa.int64())], ["file", "bytes"])

        for batch in batches:
            for page_id, url, payload, digest, size, last, revisit in zip(*batch.columns, strict=True):
                if target is None:
                    name = f"{folder}/{task:06d}-{number:06d}.warc.gz"
                    target = Target(name)
                again = revisit.as_py()
                target.write(record(
                    page_id.as_py(), url.as_py(), b"" if again else payload.as_py(), base32(digest.as_py()), size.as_py(), last.as_py(), again
                ))
                if target.size >= file_bytes:
                    yield closed()
                    target, number = None, number + 1
        if target is not None:
            yield closed()

    return run


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Rows (page_id, url, payload, digest, size, last, revisit): which pages revisit another.

    Of equal payloads of at least ``min_bytes`` the one with the largest id is the response. Rows that repeat
    that id are responses too, as are rows without an id where no row of the group has one.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(body_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"digest": F.unhex(F.sha1("payload")), "size": F.length("payload").cast("bigint")})
    # Digests alone are joined by digest. Payloads go by digest and page, so a group of copies, however large, lies in many tasks.
    last = rows.groupBy("digest").agg(F.max("page_id").alias("last"))
    again = (F.col("size") >= min_bytes) & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    page = F.concat("digest", F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary"))  # a digest has 20 bytes
    roles = rows.select("digest", "page_id", "size").distinct().join(last, "digest").select(page.alias("_page"), "last", again.alias("revisit"))
    return rows.withColumn("_page", page).join(roles, "_page").select("page_id", "url", "payload", "digest", "size", "last", "revisit")


def write(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write rows of ``with_revisits`` as archives; (file, bytes) of each, none for an empty table."""
    return stored(rows.mapInArrow(_write(folder, file_bytes), "file string, bytes bigint"))


class Bytes:
    """A file as bytes at any place, read in pieces that are kept until the next one."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        self.size, self.at, self.data = self.file.size(), 0, b""

    def read(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if not self.at <= at or at + n > self.at + len(self.data):
            self.at, self.data = at, self.file.read_at(max(n, READ_BYTES), at)
        return self.data[at - self.at : at - self.at + n]


def _is_record(source: Bytes, at: int) -> bool:
    """Whether a member begins here that decodes to a WARC head, however long; no more than its ends are kept."""
    unpacker, first, last, found = zlib.decompressobj(31), b"", b"", False
    try:
        while not unpacker.eof and not found:
            data = source.read(at, 4096)
            if not data:
                return False
            out = unpacker.decompress(data)
            at += len(data)
            first += out[: 5 - len(first)]
            if not b"WARC/".startswith(first):
                return False
            found = b"\r\n\r\n" in last + out
            last = (last + out)[-3:]
    except zlib.error:
        return False
    return found and first == b"WARC/"


def _next_record(source: Bytes, at: int, end: int) -> int | None:
    """The first place from ``at`` on and before ``end`` where a record begins."""
    step = READ_BYTES // 2
    while at < min(end, source.size):
        data, place = source.read(at, step + len(MEMBER) - 1), -1
        while (place := data.find(MEMBER, place + 1)) >= 0:
            if at + place >= end:
                return None
            if _is_record(source, at + place):
                return at + place
        at += step
    return None


def members(source: Bytes, start: int, end: int) -> Iterator[tuple[int, bytes | None]]:
    """Place and content of the records that begin in a range; None for one that is cut or damaged."""
    at = _next_record(source, start, end)
    while at is not None and at < end:
        unpacker, parts, place = zlib.decompressobj(31), [], at
        try:
            while not unpacker.eof:
                data = source.read(place, 1 << 16)
                if not data:
                    raise zlib.error("cut")
                parts.append(unpacker.decompress(data))
                place += len(data)
        except zlib.error:
            yield at, None
            at = _next_record(source, at + 1, end)
            continue
        yield at, b"".join(parts)
        at = place - len(unpacker.unused_data)
        if at < min(end, source.size) and source.read(at, len(MEMBER)) != MEMBER:
            at = _next_record(source, at, end)


def _page(name: str | None) -> int | None:
    digits = (name or "").strip("<>").removeprefix(PAGE_URN)
    return int(digits) if digits.lstrip("-").isdigit() else None


def parsed(data: bytes) -> tuple:
    """page_id, record_type, target_uri, payload_bytes, payload_digest, refers_to, payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        fields[key.strip().lower()] = value.strip()
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    size = len(payload)
    if fields["warc-type"] == "revisit":
        lengths = [line.partition(b":")[2] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
        size, payload = int(lengths[0]), None
    else:
        digest = base32(hashlib.sha1(payload).digest())
    return (_page(fields.get("warc-record-id")), fields["warc-type"], fields.get("warc-target-uri"), size, digest,
            _page(fields.get("warc-refers-to")), payload)


def _read(with_payload: bool):
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    names = ["file", "offset", "page_id", "record_type", "target_uri", "payload_bytes", "payload_digest", "refers_to", "payload"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                rows, size = [], 0
                for at, data in members(Bytes(split["file"]), split["start"], split["end"]):
                    found = (None, "damaged", *[None] * 5) if data is None else parsed(data)
                    rows.append((split["file"], at, *found[:-1], found[-1] if with_payload else None))
                    size += len(data or b"")
                    if size > 1 << 24:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return run


def read(files: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """All records of the archives in ``files`` (file, bytes), dealt to tasks by ranges of bytes, one range to a task.

    A record that is cut or damaged gives a row of record_type ``damaged`` with its place.
    """
    splits = files.select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint"))).alias("start"))
    splits = splits.select("file", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"))
    # The rows of splits are few bytes, of which adaptive execution would make one task. A number that is asked for stays.
    tasks = min(splits.count(), TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism)
    return splits.repartition(max(1, tasks)).mapInArrow(_read(with_payload), RECORD_SCHEMA)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Archive all pages in a new folder of the shared place and read every record back, without payloads.

    A null body is empty; a null URL leaves its field out. An empty table gives no record.
    """
    folder = workdir(pages.sparkSession, "warc")
    return read(write(with_revisits(pages, id_col, url_col, body_col), folder))
