"""WARC archives of one Zstandard frame per record, with a shared dictionary in front.

An archive begins with a skippable frame that holds the dictionary; then every record is a frame
of its own. Equal payloads are stored once: the record with the largest page id is the response,
the others are revisits that refer to it. The reader loads the dictionary, decodes frame by
frame and validates headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkroute.llm.common import python_workers, sent_to_all
from sparkroute.session import scratch_dir

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES, SAMPLE_BYTES, MIN_SAMPLES = 32 << 10, 2 << 20, 16
MAX_RECORD_BYTES = 1 << 30
READ_BYTES = 8 << 10
SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
NO_ID = "none"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary, error string")


class WarcError(ValueError):
    """An archive that cannot be read on, or a record that breaks the format."""


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{NO_ID if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    if not (urn.startswith("<urn:page:") and urn.endswith(">")):
        raise WarcError(f"record id {urn[:40]!r}")
    name = urn[10:-1]
    return None if name == NO_ID else int(name)


def _escaped(url: str) -> str:
    """A header value on one line; percent signs are escaped too, so it can be undone."""
    return "".join(f"%{ord(c):02X}" if c in "%\r\n\t " else c for c in url)


def _plain(value: str) -> str:
    for c in "\r\n\t %":  # the percent sign last
        value = value.replace(f"%{ord(c):02X}", c)
    return value


def record_bytes(page_id, url, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit leaves the payload out but keeps its digest and length."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_escaped(url)}")
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive_bytes(records: list[bytes]) -> bytes:
    """An archive of ``records``: dictionary frame, then a frame for each."""
    samples, size = [], 0
    for r in records[:: max(1, len(records) // 256)]:
        samples.append(r[: 64 << 10])
        size += len(samples[-1])
        if size > SAMPLE_BYTES:
            break
    raw = b""
    if len(samples) >= MIN_SAMPLES:
        try:
            raw = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            raw = b""
    raw = raw or samples[0][:DICTIONARY_BYTES].ljust(8, b" ")
    packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=True, write_checksum=True)
    return b"".join([struct.pack("<II", SKIPPABLE, len(raw)), raw, *[packer.compress(r) for r in records]])


def _headers(lines: list[str]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in found:
            raise WarcError(f"header {line[:60]!r}")
        found[name.lower()] = value.strip()
    return found


def parsed(record: bytes) -> tuple:
    """The fields of one record; raises ``WarcError`` if it breaks the format."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or lines[0] != "WARC/1.1":
        raise WarcError(f"version line {lines[0][:20]!r}")
    h = _headers(lines[1:])
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest", "warc-block-digest"} - set(h)
    if missing or not h["content-length"].isdigit():
        raise WarcError(f"missing or bad headers {sorted(missing)}")
    size = int(h["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"block of {len(rest) - 4} bytes, declared {size}")
    block = rest[:size]
    if "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() != h["warc-block-digest"]:
        raise WarcError("block digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    inner = _headers(http.decode("latin-1").split("\r\n")[1:])
    if not gap or not inner.get("content-length", "").isdigit():
        raise WarcError("no HTTP header")
    length, kind = int(inner["content-length"]), h["warc-type"]
    name, _, digest = h["warc-payload-digest"].partition(":")
    if name != "sha1" or len(digest) != 32:
        raise WarcError("payload digest is not SHA-1")
    digest = base64.b32decode(digest).hex()
    refers = None
    if kind == "revisit":
        if payload or h.get("warc-profile") != _PROFILE or "warc-refers-to" not in h:
            raise WarcError("revisit with a payload, or without a profile or target")
        refers, payload = _page_of(h["warc-refers-to"]), None
    elif kind != "response":
        raise WarcError(f"type {kind[:20]!r}")
    elif len(payload) != length or hashlib.sha1(payload).hexdigest() != digest:
        raise WarcError("payload length or digest differs")
    url = h.get("warc-target-uri")
    return _page_of(h["warc-record-id"]), None if url is None else _plain(url), kind, refers, length, digest, payload, None


def read_records(content: bytes) -> Iterator[tuple]:
    """The records of an archive. A broken record or archive gives a row that has only ``error``."""
    view = memoryview(content)
    try:
        if len(content) < 8:
            raise WarcError("no dictionary frame")
        magic, size = struct.unpack_from("<II", content)
        if magic != SKIPPABLE or 8 + size > len(content):
            raise WarcError("no dictionary frame")
        raw = content[8 : 8 + size]
        if raw[:4] == ZSTD_MAGIC:  # the dictionary may be compressed itself
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=MAX_RECORD_BYTES)
    except (WarcError, zstandard.ZstdError) as error:
        yield (*[None] * 7, f"archive: {error}")
        return
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    at = 8 + size
    while at < len(content):
        reader = unpacker.decompressobj()
        parts, end = [], at
        try:
            while not reader.eof:
                if end >= len(content):
                    raise WarcError("frame cut short")
                parts.append(reader.decompress(view[end : end + READ_BYTES]))
                end = min(end + READ_BYTES, len(content))
            record = b"".join(parts)
        except (zstandard.ZstdError, WarcError) as error:
            yield (*[None] * 7, f"frame at byte {at}: {error}")
            return
        at = end - len(reader.unused_data)
        try:
            yield parsed(record)
        except (WarcError, ValueError) as error:
            yield (*[None] * 7, f"record before byte {at}: {error}")


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   folder: str | None = None) -> str:
    """Write a record for each row of ``pages`` below ``folder`` and return it.

    The folder is new, in the session's shared folder unless given. Tasks write archives of about
    ``ARCHIVE_BYTES``, a longer record alone, under a name of their own; the names of the tasks that
    succeeded are the ones that count, so a task that is run twice leaves nothing that is read.

    Defined results: a null html is the empty payload; a null id is kept as such and is the
    smallest; a null url has no target header; of equal payloads from 1000 bytes on the row with
    the largest id is the response, and if rows of that id are equal, each of them is; other
    columns are not read; an empty table gives an empty folder.
    """
    spark = pages.sparkSession
    python_workers(spark)
    target = folder or scratch_dir(spark, "warc")
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").alias("url"), html.alias("html"))
    long_ = F.octet_length("html") >= MIN_REVISIT_BYTES
    digest = F.when(long_, F.sha1(F.col("html").cast("binary")))
    groups = rows.select("id", digest.alias("of")).where("of is not null").groupBy("of").agg(
        F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("of", "first")
    met = rows.withColumn("digest", digest).join(sent_to_all(groups, row_bytes=72), F.col("digest") == F.col("of"), "left")
    ready = met.select("id", "url", "html", "first")

    def write(batches):
        store, base = _store(target)
        context = TaskContext.get()
        records, size, part = [], 0, 0

        def flush():
            name = f"{context.partitionId():06d}-{part:05d}-{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(posixpath.join(base, name)) as out:
                out.write(archive_bytes(records))
            return pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

        store.create_dir(base, recursive=True)
        for batch in batches:
            for page, url, body, first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                made = record_bytes(page, url, body.encode("utf-8", "surrogatepass"), first, first is not None and first != page)
                if records and size + len(made) > ARCHIVE_BYTES:
                    yield flush()
                    records, size, part = [], 0, part + 1
                records.append(made)
                size += len(made)
        if records:
            yield flush()

    ready.mapInArrow(write, "name string").write.parquet(f"{target}/_names")
    return target


def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and the path of ``uri``; a plain path is local."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:") and not uri.startswith("file://"):
            uri = "file://" + uri[5:]
        return pyarrow.fs.FileSystem.from_uri(uri)
    return pyarrow.fs.LocalFileSystem(), uri


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives that ``write_archives`` finished in ``folder``.

    ``error`` says what is wrong with a record that breaks the format; the archive is read on
    behind it, unless the frames themselves are broken. Payloads of revisits are null.
    """
    python_workers(spark)
    names = spark.read.schema("name string").parquet(f"{folder}/_names")

    def read(batches):
        store, base = _store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(posixpath.join(base, name)) as stream:
                    content = stream.read()
                rows, size = [], 0
                for row in read_records(content):
                    rows.append(row)
                    size += len(row[6] or b"")
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return names.repartition(max(1, spark.sparkContext.defaultParallelism * 4)).mapInArrow(read, SCHEMA)


_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)
