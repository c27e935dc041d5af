"""WARC archives: written and read by tasks, one gzip member per record.

Writing: each task streams its rows into archives of its own below a folder that the cluster
shares, starts another file when one is full, and returns a manifest row per file. A file's
name holds a random part, so a task that runs again writes other files and only those of the
attempt that counts are in the manifest.

Reading: each file of the manifest is read front to back in small pieces. The decompressor
is restarted at every member, a record is cut out by its Content-Length, and its payload is
checked against the digest it carries.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from uuid import uuid4

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxysift.session import durable, shared_folder

REVISIT_FROM_BYTES = 1000
FILE_BYTES = 256 * 1024 * 1024
PIECE_BYTES = 64 * 1024
DATE = "2024-01-01T00:00:00Z"

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "file string, records bigint, bytes bigint"
_RECORD = """page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint,
    payload_digest string, payload binary, intact boolean"""


def plan_records(pages: DataFrame, revisit_from: int = REVISIT_FROM_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to, revisit`` per row of ``page_id, url, html``.

    Of equal payloads of at least ``revisit_from`` bytes the largest page_id is the response
    (each row that repeats it too); a null page_id is smaller than any. The class of a
    payload is found from narrow rows that are combined before they are shuffled.
    """
    payload = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    classes = (
        rows.where(F.col("size") >= revisit_from).groupBy("digest", "size")
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    )
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return rows.join(classes, ["digest", "size"], "left").select(
        "page_id", "url", "payload", "digest", revisit.alias("revisit"),
        F.when(revisit, F.col("newest")).alias("refers_to"),
    )


def _record_id(page: int | None) -> str:
    return f"<urn:x-page:{'none' if page is None else page}>"


def _page_of(record_id: str) -> int | None:
    name = record_id.rsplit(":", 1)[1].rstrip(">")
    return None if name == "none" else int(name)


def _header_safe(url: str) -> str:
    """Percent-encode what would end a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def format_record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record: named fields, an HTTP head, and the payload unless it is a revisit."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", _header_safe(url)))
    if revisit:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the planned records below ``folder``; returns the manifest of the files.

    ``folder`` is a URI that every executor reaches. The manifest is stored, so that the
    archives are written once however often it is read.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        stream, name, count, size, done = None, "", 0, 0, []
        for batch in batches:
            ids = batch["page_id"].tolist(), batch["refers_to"].tolist()
            for page, refers, url, payload, digest, revisit in zip(
                *ids, batch["url"], batch["payload"], batch["digest"], batch["revisit"], strict=True
            ):
                if stream is None:
                    name, count, size = f"{path}/{uuid4().hex}.warc.gz", 0, 0
                    # The content is compressed already; the suffix must not add a layer.
                    stream = store.open_output_stream(name, compression=None)
                page, refers = (None if x == "" else int(x) for x in (page, refers))
                member = gzip_member(format_record(page, url, bytes(payload), digest, refers, revisit))
                stream.write(member)
                count, size = count + 1, size + len(member)
                if size >= file_bytes:
                    stream.close()
                    done.append((name, count, size))
                    stream = None
        if stream is not None:
            stream.close()
            done.append((name, count, size))
        yield pd.DataFrame(done, columns=["file", "records", "bytes"])

    # Ids travel as text: a null would turn a column of numbers into floats.
    texts = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("page_id", "refers_to")]
    return durable(records.select(*texts, "url", "payload", "digest", "revisit").mapInPandas(write, _MANIFEST))


class RecordError(ValueError):
    """An archive that does not follow the format."""


class _Members:
    """Bytes of the gzip members of a stream, decompressed piece by piece."""

    def __init__(self, stream) -> None:
        self.stream, self.packed, self.plain = stream, b"", bytearray()
        self.unpacker = zlib.decompressobj(31)
        self.ended = False

    def _more(self) -> bool:
        """Decompress one more piece; False at the end of the current member."""
        while True:
            if self.unpacker.eof:
                self.packed = self.unpacker.unused_data or self.packed
                return False
            if not self.packed:
                self.packed = self.stream.read(PIECE_BYTES)
                if not self.packed:
                    raise RecordError("archive ends within a member")
            piece = self.unpacker.decompress(self.packed, PIECE_BYTES)
            self.packed = self.unpacker.unconsumed_tail
            if piece:
                self.plain += piece
                return True

    def next_member(self) -> bool:
        """Go to the start of the next member; False at the end of the archive."""
        self.packed = self.packed or self.stream.read(PIECE_BYTES)
        if not self.packed:
            return False
        self.unpacker, self.plain = zlib.decompressobj(31), bytearray()
        return True

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (at := self.plain.find(mark, start)) < 0:
            start = max(0, len(self.plain) - len(mark) + 1)
            if not self._more():
                raise RecordError("record head does not end")
        return self.take(at + len(mark))

    def take(self, size: int) -> bytes:
        while len(self.plain) < size:
            if not self._more():
                raise RecordError("record is shorter than its Content-Length")
        out = bytes(self.plain[:size])
        del self.plain[:size]
        return out

    def finish(self) -> bytes:
        while self._more():
            pass
        self.packed = self.unpacker.unused_data
        return bytes(self.plain)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


def read_records(stream) -> Iterator[tuple]:
    """Records of one archive, in order: fields of the record, payload, whether it is intact.

    ``payload_bytes`` is the length the HTTP head names, so that a revisit, which has no
    payload, still tells it. A response is intact if its payload has that length and digest.
    """
    members = _Members(stream)
    while members.next_member():
        head = members.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/1."):
            raise RecordError("no WARC record")
        named = _fields(head)
        block = members.take(int(named["content-length"]))
        if members.finish() != b"\r\n\r\n":
            raise RecordError("record is longer than its Content-Length")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(_fields(http)["content-length"])
        digest = base64.b32decode(named["warc-payload-digest"].removeprefix("sha1:")).hex()
        revisit = named["warc-type"] == "revisit"
        intact = revisit or (len(payload) == size and hashlib.sha1(payload).hexdigest() == digest)
        yield (
            _page_of(named["warc-record-id"]), named.get("warc-target-uri"), named["warc-type"],
            _page_of(named["warc-refers-to"]) if revisit else None, size, digest,
            None if revisit else payload, intact,
        )


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Records of the archives in a manifest; a file is a task, a damaged file an error."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "intact"]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        return out.assign(**{name: pd.array(out[name].tolist(), dtype="Int64") for name in ("page_id", "refers_to")}
                          if rows else {})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch["file"]:
                rows, size = [], 0
                with store.open_input_stream(name, compression=None, buffer_size=PIECE_BYTES) as stream:
                    for record in read_records(stream):
                        rows.append([None if pd.isna(x) else x for x in record[:4]] + list(record[4:]))
                        size += len(record[6] or b"")
                        if size >= 8 * 1024 * 1024 or len(rows) >= 10_000:
                            yield frame(rows)
                            rows, size = [], 0
                if rows:
                    yield frame(rows)

    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, 1)
    files = manifest.select("file")
    # Files are dealt one by one; there are at most a few per task that wrote them.
    return files.repartition(max(tasks, files.count())).mapInPandas(read, _RECORD)


def archived(pages: DataFrame, folder: str | None = None, revisit_from: int = REVISIT_FROM_BYTES) -> DataFrame:
    """Write a record per page, read the archives back, and check them.

    A null html is an empty payload, a null url leaves out the target. Raises in the task
    that finds a payload which is not what its digest says.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc-{uuid4().hex}"
    manifest = write_archives(plan_records(pages, revisit_from), folder)
    records = read_archives(manifest, folder)
    return records.where(F.when(F.col("intact"), True).otherwise(F.raise_error(F.lit("payload differs from its digest")).cast("boolean")))
