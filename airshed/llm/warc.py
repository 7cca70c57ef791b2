"""WARC archives with a Zstandard dictionary.

An archive is a file of Zstandard frames: first a skippable frame that holds
the dictionary, then one frame for each WARC record, compressed on its own
with that dictionary, so that any record can be read by its offset. The
dictionary is trained on a bounded sample of the records that are archived.
Records with equal payloads become revisits of the one with the smallest page id.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import scratch, slices, table, written

#: First bytes of the skippable frame that holds a dictionary, and of a trained dictionary.
DICTIONARY_FRAME = b"\x5d\x2a\x4d\x18"
#: Payloads below this length are always archived in full.
REVISIT_FROM_BYTES = 100
#: The dictionary's size, and the sample it is trained on: at most so many records, none larger than so many bytes.
DICTIONARY_BYTES, SAMPLE_RECORDS, SAMPLE_RECORD_BYTES = 64 << 10, 1000, 32 << 10
#: A writer starts another archive beyond this size.
ARCHIVE_BYTES = 1 << 30

RECORD_SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
                 "payload_digest string, payload binary, archive string, offset long")


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and plain path of a URI, or of a local path."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def classify(pages: DataFrame) -> DataFrame:
    """Add the digest, length and verdict of each page's payload.

    ``pages``: page_id (long, may be null), url, html (null: empty). Of pages with
    equal payloads of at least 100 bytes the smallest page_id responds and the
    others revisit it; a null page_id counts as the largest. Rows that repeat both the
    page_id and the payload are one page and share its verdict. Other columns are left behind.
    Only digests and ids are grouped (with partial sums, so a payload that many
    pages share costs one row per task); the pages then meet their group in a plain
    equi-join, whose hot partitions adaptive execution splits.
    """
    payload = F.coalesce(pages["html"], F.lit("")).cast("binary")
    p = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                     F.octet_length(payload).cast("long").alias("n_bytes"), F.sha2(payload, 256).alias("digest"),
                     payload.alias("payload"))
    groups = (p.filter(F.col("n_bytes") >= REVISIT_FROM_BYTES).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return p.join(groups, "digest", "left").withColumn("revisit", revisit).withColumn("refers_to", F.when(revisit, F.col("first")))


def train_dictionary(pages: DataFrame, n_records: int = SAMPLE_RECORDS, n_bytes: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from the distinct payloads with the ``n_records`` smallest
    digests (a sample that depends on no order), each between 8 bytes and 32 KB.
    Too few or too uniform records for the trainer: their bytes themselves serve
    as a raw dictionary. No such record: an empty dictionary, and no leading frame."""
    payload = F.coalesce(pages["html"], F.lit("")).cast("binary")
    p = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload")).filter(
        F.octet_length("payload").between(8, SAMPLE_RECORD_BYTES))
    drawn = p.select("digest").distinct().orderBy("digest").limit(n_records)
    sample = [bytes(r[1]) for r in p.join(F.broadcast(drawn), "digest").groupBy("digest")
              .agg(F.first("payload")).orderBy("digest").collect()]
    if sum(map(len, sample)) >= 16 * n_bytes and len(sample) >= 16:
        try:
            return zstandard.train_dictionary(n_bytes, sample, level=3).as_bytes()
        except zstandard.ZstdError:  # the trainer found nothing that repeats
            pass
    return b"".join(sample)[:n_bytes]


def _record(page_id, url, payload: bytes, digest: str, n_bytes: int, revisit: bool, refers_to, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    body = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{_id(page_id)}:{digest}>"),
              ("WARC-Date", date), ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
              ("WARC-Page-ID", _id(page_id)), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}:{digest}>")]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + body + b"\r\n\r\n"


def _id(page_id) -> str:
    return "null" if page_id is None else str(page_id)


def write_archives(pages: DataFrame, folder: str, dictionary: bytes, date: dt.datetime) -> DataFrame:
    """Write every row of ``classify`` as a record below ``folder``; returns the
    written table of archives (path, records, bytes). A repeated task writes under
    another name, and only archives of successful attempts are in that table."""
    stamp = date.strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True)
        where, root = open_path(folder)
        where.create_dir(root, recursive=True)
        done, out, n, size = [], None, 0, 0
        for batch in batches:
            for row in (r for a, b in slices(batch.num_rows, 200) for r in zip(*(c.to_pylist() for c in batch.slice(a, b - a).columns), strict=True)):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out, n, size = where.open_output_stream(f"{root}/{name}"), 0, 0
                    if dictionary:
                        size += out.write(DICTIONARY_FRAME + struct.pack("<I", len(dictionary)) + dictionary)
                size += out.write(packer.compress(_record(*row, stamp)))
                n += 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n, size))
        yield pa.RecordBatch.from_pydict({"path": [d[0] for d in done], "records": [d[1] for d in done], "bytes": [d[2] for d in done]},
                                         schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    columns = pages.select("page_id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"),
                           "digest", "n_bytes", "revisit", "refers_to")
    return written(columns.mapInArrow(write, "path string, records long, bytes long"), "warc-archives")


def _blocks(source, size: int = 1 << 20) -> Iterator[bytes]:
    while block := source.read(size):
        yield block


def read_archive(path: str) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each record of one archive, in bounded memory (one record)."""
    where, name = open_path(path)
    with where.open_input_stream(name) as source:
        blocks, held, at, trained = _blocks(source), b"", 0, None
        held = next(blocks, b"")
        if held[:4] == DICTIONARY_FRAME:
            length = 8 + struct.unpack("<I", held[4:8])[0]
            while len(held) < length:
                held += next(blocks)
            trained, held, at = zstandard.ZstdCompressionDict(held[8:length]), held[length:], length
        unpacker = zstandard.ZstdDecompressor(dict_data=trained)
        while held or (held := next(blocks, b"")):
            frame, parts, used = unpacker.decompressobj(), [], len(held)
            parts.append(frame.decompress(held))
            while not frame.eof:
                held = next(blocks, None)
                if held is None:
                    raise ValueError(f"{path}: the record at {at} is cut off")
                used += len(held)
                parts.append(frame.decompress(held))
            held = frame.unused_data
            yield at, b"".join(parts)
            at += used - len(held)


def parse_record(content: bytes) -> tuple:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload of
    one record. A response's digest and length are computed from its payload and must equal its header."""
    head, _, rest = content.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    if first != "WARC/1.1":
        raise ValueError(f"not a WARC record: {first!r}")
    body = rest[:int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    n_bytes = int(http.rpartition(b"Content-Length: ")[2])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != n_bytes or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload differs from its digest")
    number = lambda x: None if x == "null" else int(x)
    refers = int(fields["WARC-Refers-To"].split(":")[2]) if kind == "revisit" else None
    return (number(fields["WARC-Page-ID"]), fields["WARC-Target-URI"], kind, refers, n_bytes, digest,
            payload if kind == "response" else None)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives listed in ``archives`` (path), one task for
    each few archives. ``payloads=False`` checks the payloads but leaves them out."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "archive", "offset"]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
                                        pa.string(), pa.int64()], strict=True)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for offset, content in read_archive(path):
                    row = parse_record(content)
                    rows.append((*row[:6], row[6] if payloads else None, path, offset))
                    size += len(content) if payloads else 100
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    n = max(1, archives.count())
    return archives.select("path").repartitionByRange(n, "path").mapInArrow(read, RECORD_SCHEMA)


def archive_pages(pages: DataFrame, folder: str, date: dt.datetime | None = None) -> DataFrame:
    """Archive all pages below ``folder``; returns the table of archives."""
    return write_archives(classify(pages), folder, train_dictionary(pages), date or dt.datetime.now(dt.timezone.utc))


def op2_dictionary_warc(spark, sf_dir: str) -> DataFrame:
    """Archive all pages, read the archives back and return what they hold of each page."""
    archives = archive_pages(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return read_archives(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
        CASE WHEN strlen(coalesce(html, '')) >= 100 THEN min(page_id) OVER (PARTITION BY coalesce(html, '')) END AS first FROM pages)
"""
