"""WARC archives in Zstandard frames: written by Spark to any file system, read back and checked.

An archive is a skippable frame that holds the compression dictionary, then one frame per record,
so that a reader can decode any record by itself. Archives are written through Spark's own text
writer, one file per row: a row's string is the archive's bytes, and the line end that the writer
adds is an empty skippable frame, which every Zstandard reader passes over.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import attach, smallest
from tidemark.session import materialize, run_folder, ship_code

# Frame numbers of the format; a dictionary is in the skippable frame 0x184D2A5D.
DICTIONARY_FRAME = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bytes of records (before compression) per archive; a longer record is an archive by itself.
ARCHIVE_BYTES = 64_000_000
#: The dictionary is trained on this many pages at most, those with the smallest hashes, and this much of each.
TRAIN_PAGES = 400
TRAIN_BYTES = 20_000
DICTIONARY_BYTES = 65_536


class BadRecord(ValueError):
    """An archive whose frames, headers, lengths or digests do not hold."""


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of a SHA-1: eight groups of five hex digits, four letters each."""
    digits = F.sha1(payload)
    letters = []
    for g in range(8):
        value = F.conv(F.substring(digits, 5 * g + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(ALPHABET), F.shiftright(value, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def train(pages: DataFrame, html: str = "html") -> bytes:
    """A dictionary from a bounded sample; empty where the sample is too small for one."""
    sample = pages.where(F.length(html) > 0).select(F.substring(html, 1, TRAIN_BYTES).alias("p"), F.xxhash64(html).alias("h"))
    texts = [r["p"].encode() for r in smallest(sample, "h", TRAIN_PAGES, pages.count()).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes() if len(texts) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _header_value(value: str) -> str:
    """A header is one line: control characters are percent-encoded, as is the percent sign."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "%\x7f" else c for c in value)


def _plain(value: str) -> str:
    parts = value.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def record(page_id, url: str | None, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """One WARC record: headers, an empty line, the payload (none for a revisit), two line ends."""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    body = payload
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        body = b""
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def frames(data: bytes, words: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(words)) + words + data


def classify(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """(page_id, url, html, bytes, digest, first): ``first`` is the smallest key with the same payload.

    It is null for payloads under ``least`` bytes, where no key is known, and for the first itself.
    """
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", base32_sha1(F.col("html")))
    facts = materialize(rows.groupBy("digest", "bytes").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")), "warc-digests")
    total = facts.agg(F.sum("n")).first()[0] or 0
    first = F.when((F.col("bytes") >= least) & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return attach(rows, facts, ["digest", "bytes"], "n", total).withColumn("first", first).drop("n")


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> None:
    """Archives of all pages below ``folder``. A null payload is empty; a null url has no header."""
    ship_code(pages.sparkSession)
    words = train(pages, html)
    level, limit = 3, ARCHIVE_BYTES

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(words) if words else None
        press = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True, write_content_size=True)
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                columns = [part.column(i).to_pylist() for i in (0, 1, 3, 4, 5)]
                for page, link, n, digest, first, payload in zip(*columns, part.column(2).cast(pa.binary()).to_pylist()):
                    raw = record(page, link, payload, digest, n, first)
                    held.append(press.compress(raw))
                    size += len(raw)
                    if size >= limit:
                        yield pa.RecordBatch.from_arrays([pa.array([frames(b"".join(held), words)], pa.binary())], ["archive"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([frames(b"".join(held), words)], pa.binary())], ["archive"])

    rows = classify(pages, key, url, html, least).select("page_id", "url", "html", "bytes", "digest", "first")
    archives = rows.mapInArrow(task, "archive binary")
    archives.select(F.col("archive").cast("string")).write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(folder)


def read_frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded record) of each frame of an archive, one at a time."""
    view, at, decoder = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at < 8:
            raise BadRecord(f"{len(view) - at} bytes after the last frame")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            if at + 8 + size > len(view):
                raise BadRecord(f"the skippable frame at {at} is cut off")
            if magic == DICTIONARY_FRAME:
                if at:
                    raise BadRecord(f"a dictionary at {at}, not at the start")
                words = bytes(view[8:8 + size])
                words = zstandard.ZstdDecompressor().decompress(words) if words[:4] == b"\x28\xb5\x2f\xfd" else words
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words)) if words else decoder
            at += 8 + size
            continue
        frame, parts, start = decoder.decompressobj(), [], at
        try:
            while not frame.eof and at < len(view):
                step = view[at:at + 65_536]
                parts.append(frame.decompress(step))
                at += len(step) - len(frame.unused_data)
        except zstandard.ZstdError as e:
            raise BadRecord(f"the frame at {start}: {e}") from e
        if not frame.eof:
            raise BadRecord(f"the frame at {start} is cut off")
        yield start, b"".join(parts)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and body of a record; raises where it is not whole."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise BadRecord("no WARC version line")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name.lower() in headers:
            raise BadRecord(f"header line {line[:60]!r}")
        headers[name.lower()] = value.strip(" \t")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise BadRecord(f"no {name}")
    size = headers["content-length"]
    if not size.isdecimal() or len(rest) != int(size) + 4 or rest[int(size):] != b"\r\n\r\n":
        raise BadRecord(f"content-length {size[:20]} with {len(rest) - 4} bytes")
    return headers, rest[:int(size)]


def checked(raw: bytes) -> tuple[str, str | None, str, str, int, str | None, bytes]:
    """(record id, url, type, digest, payload length, refers to, payload) of a record that holds."""
    headers, body = parse(raw)
    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
    refers, size = headers.get("warc-refers-to"), int(headers.get("x-payload-length", len(body)))
    if kind not in ("response", "revisit") or (kind == "revisit") != (refers is not None):
        raise BadRecord(f"type {kind[:20]} with refers-to {refers}")
    if kind == "response" and (size != len(body) or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest):
        raise BadRecord("payload length or digest")
    if kind == "revisit" and body:
        raise BadRecord("a revisit with a payload")
    name = lambda v: v.removeprefix("<urn:page:").removesuffix(">")
    url = headers.get("warc-target-uri")
    return name(headers["warc-record-id"]), None if url is None else _plain(url), kind, digest, size, refers and name(refers), body


def read_archives(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame:
    """Records (record_id, url, record_type, payload_digest, payload_bytes, refers_to, payload, problem).

    A record that does not hold fails the job, or with ``strict`` off becomes a row with only
    ``problem`` set. A frame that does not decode ends its archive, for nothing behind it is sure.
    """
    ship_code(spark)
    names = ["record_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload", "problem"]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]

    def rows_of(path: str, data: bytes) -> Iterator[tuple]:
        at = 0
        try:
            for at, raw in read_frames(data):
                try:
                    yield *checked(raw), None
                except BadRecord as e:
                    if strict:
                        raise
                    yield *[None] * 7, f"{path} at {at}: {e}"
        except BadRecord as e:
            if strict:
                raise BadRecord(f"{path} at {at}: {e}") from e
            yield *[None] * 7, f"{path} after {at}: {e}"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                held, size = [], 0
                for row in rows_of(path, data.as_py()):
                    held.append(row)
                    size += len(row[6] or b"") + 200
                    if size > 4_000_000:
                        yield _batch(held, names, types)
                        held, size = [], 0
                if held:
                    yield _batch(held, names, types)

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    kinds = "record_id string, url string, record_type string, payload_digest string, payload_bytes long, refers_to string, payload binary, problem string"
    return files.mapInArrow(task, kinds)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """The records of ``pages`` as read back from archives written below the shared folder.

    Columns as in ``read_archives``, with ids in the key's type. Every row is a record, also rows
    that repeat: rows of the smallest key with a payload are all responses. Null keys are later
    than all others, and responses where no key has the payload. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = run_folder(spark, "warc")
    write_archives(pages, folder, key, url, html, least)
    kind = dict(pages.dtypes)[key]
    back = read_archives(spark, folder)
    known = lambda c: F.when(F.col(c) != "None", F.col(c)).cast(kind)
    return back.withColumns({"record_id": known("record_id"), "refers_to": known("refers_to")})
