"""WARC archives compressed record by record with a Zstandard dictionary of their own."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.storage import shared_dir

# Zstandard's frame numbers, and those of the archive format.
_FRAME = 0xFD2FB528
_SKIPPED = 0x184D2A50  # and the fifteen numbers after it
_DICTIONARY_FRAME = 0x184D2A5D
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An empty skippable frame that is also text, so that Spark's text writer can put
#: it between records: readers of Zstandard pass over it.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"

#: Records that a dictionary is built from: the first ones of its archive.
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 32 << 10
_PAGE = "urn:page:"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _digest(payload: bytes) -> str:
    """SHA-1 in base32, upper case, which has no padding for 20 bytes."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line_safe(text: str) -> str:
    """No control character or blank can end a header line early."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _record(
    page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str
) -> bytes:
    """One record, its payload left out if it refers to another page's.

    The HTTP header has the full payload's length in either case.
    """
    digest = _digest(payload)
    name = "null" if page is None else str(page)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Target-URI", _line_safe(url) if url else f"{_PAGE}{name}"),
        ("WARC-Date", date),
        ("WARC-Record-ID", f"<{_PAGE}{name}>"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{_PAGE}{refers_to}>")]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return _VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _parsed(record: bytes) -> dict[str, str | bytes]:
    """Header fields by lower-case name, and the block."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != _VERSION:
        raise ValueError(f"not a record: {version[:40]!r}")
    fields: dict = {}
    for line in lines:
        name, _, value = line.partition(b":")
        fields[name.decode().strip().lower()] = value.decode().strip()
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} has another length than it says")
    fields["block"] = rest[:length]
    return fields


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the records; made of their ends as they are where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=512, d=8)
    except zstandard.ZstdError:
        content = b"".join(records)[-DICTIONARY_BYTES:].ljust(8, b"\0")
        return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive_frames(records: Iterator[bytes], level: int = 3) -> Iterator[bytes]:
    """The frames of one archive: its dictionary in a skippable one, then one for each record."""
    held, size = [], 0
    for record in records:
        held.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    if not held:
        return
    dictionary = _dictionary(held)
    content = dictionary.as_bytes()
    yield _DICTIONARY_FRAME.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content
    compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary)
    for record in held:
        yield compressor.compress(record)
    for record in records:
        yield compressor.compress(record)


def archive_records(content: memoryview) -> Iterator[bytes]:
    """The records of one archive, frame by frame; a frame is read by the dictionary before it."""
    at, reader = 0, zstandard.ZstdDecompressor()
    while at < len(content):
        magic = int.from_bytes(content[at : at + 4], "little")
        if magic & ~0xF == _SKIPPED:
            size = int.from_bytes(content[at + 4 : at + 8], "little")
            if magic == _DICTIONARY_FRAME:
                data = zstandard.ZstdCompressionDict(bytes(content[at + 8 : at + 8 + size]))
                reader = zstandard.ZstdDecompressor(dict_data=data)
            at += 8 + size
        elif magic == _FRAME:
            frame, parts = reader.decompressobj(), []
            while not frame.eof:
                piece = content[at : at + (16 << 10)]
                if not piece:
                    raise ValueError("the archive ends in the middle of a record")
                parts.append(frame.decompress(piece))
                at += len(piece) - len(frame.unused_data)
            yield b"".join(parts)
        elif magic & 0xFF == 0x0A:  # a line end some writers add
            at += 1
        else:
            raise ValueError(f"no frame at byte {at}")


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``payload`` (UTF-8; null: empty), ``refers_to``.

    Of equal payloads of ``min_bytes`` at least, the page with the smallest id is the
    response, others refer to it; rows that share the smallest id are all responses, a
    null id counts as larger than any, and without any id all are responses.

    Only payloads that occur twice are looked up, by digest; ids are combined before the
    shuffle. A payload that a third of all pages have makes one row there, and
    adaptive execution splits its side of the join.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    rows = rows.withColumn("_digest", F.sha1("payload"))
    many = (
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy(F.col("_digest").alias("_same"))
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1 AND _first IS NOT NULL")
    )
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("_first"))
    return rows.join(many, F.col("_digest") == F.col("_same"), "left").select(
        "page_id", "url", "payload", F.when(later, F.col("_first")).alias("refers_to")
    )


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z"
) -> None:
    """Write ``page_id, url, html`` rows as archives under ``path``, one for each partition.

    A row makes one record, a response or a revisit (:func:`with_revisits`), each a
    Zstandard frame of its own. An archive begins with a skippable frame that holds the
    dictionary its frames need, built from its first ``SAMPLE_BYTES`` of records.
    Records hold whatever bytes a page has. Spark's text writer puts the frames in
    place, so any file system it knows will do, and a lost task is written again.
    Null urls are replaced by the page's id; an empty table writes no archive. Other columns are not read. A page needs
    some five times its size in memory. A reader takes an archive whole, up to 2 GB: partitions must hold less
    than that, compressed.
    """

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (
            _record(page, url, payload, refers_to, date)
            for batch in batches
            for page, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns))
        )
        held, size = [], 0
        for frame in archive_frames(records):
            held.append(frame)
            size += len(frame)
            if size >= 1 << 20:
                yield pa.RecordBatch.from_pydict({"frame": pa.array(held, pa.binary())})
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"frame": pa.array(held, pa.binary())})

    rows = with_revisits(pages, min_bytes).mapInArrow(frames, "frame binary")
    # The writer puts out a string's bytes as they are.
    rows.select(F.col("frame").cast("string").alias("value")).write.text(path, lineSep=SEPARATOR)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``; a whole archive is read by one task.

    ``payload`` is null for revisits. The digest of a response is taken from the
    payload read and must be the one its header has.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for record in archive_records(memoryview(content.as_buffer())):
                    rows.append(_row(_parsed(record)))
                    size += len(record)
                    if size >= 4 << 20:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").load(path)
    return files.select("content").mapInArrow(parse, _READ)


def _page(uri: str | None) -> int | None:
    number = uri.strip("<>").removeprefix(_PAGE) if uri else "null"
    return None if number == "null" else int(number)


def _row(fields: dict) -> tuple:
    head, _, payload = fields["block"].partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    length = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
    kind = fields["warc-type"]
    if kind == "response" and (len(payload), _digest(payload)) != (length, digest):
        raise ValueError(f"{fields['warc-record-id']}: the payload is not what its header says")
    return (
        _page(fields["warc-record-id"]),
        length,
        digest,
        kind,
        _page(fields.get("warc-refers-to")),
        fields["warc-target-uri"],
        payload if kind == "response" else None,
    )


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)
