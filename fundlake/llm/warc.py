"""WARC archives with an index: written once, read by coalesced byte ranges.

Each task writes one archive of gzip members, one per record, and returns an index row for each:
offset, length, URL and payload digest. Only the index rows of tasks that succeeded are kept, so
a repeated task leaves no doubt which file counts. A reader sorts the selected index rows by
archive and offset and joins neighbouring ranges into one read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import ROW, batched, fixed, rows_of
from fundlake.session import discard, shared_folder, stored

LEAST_REVISIT_BYTES = 100
#: Ranges nearer than this are read as one, up to the largest read.
NEAR_BYTES = 64 << 10
READ_BYTES = 4 << 20
#: Index rows of one archive are dealt to tasks by stretches of so many bytes.
STRETCH_BYTES = 64 << 20

_INDEX = pa.schema(
    [
        ("record", pa.int64()),
        ("page_id", pa.int64()),
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("url", pa.string()),
        ("payload_digest", pa.string()),
    ]
)
_INDEX_SQL = "record long, page_id long, archive string, offset long, length long, url string, payload_digest string"
_RECORDS = pa.schema(
    [
        ("record", pa.int64()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to_record", pa.int64()),
        ("refers_to", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)
_RECORDS_SQL = (
    "record long, page_id long, url string, record_type string, refers_to_record long, refers_to long, "
    "payload_digest string, payload binary"
)


def record_id(record: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(record))}>"


def to_record(record: int, page, url, digest: str, refers, refers_page, data: bytes, date: str) -> bytes:
    """One record; a revisit has headers only and names the record and page that it repeats."""
    body = b"" if refers is not None else data
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(record)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
        f"X-Record: {record}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(url.splitlines()))
    if page is not None:
        lines.append(f"X-Page: {page}")
    if refers is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers)}",
            f"X-Refers-To-Record: {refers}",
        ]
        if refers_page is not None:
            lines.append(f"X-Refers-To-Page: {refers_page}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def from_record(raw: bytes) -> tuple:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    size = int(fields["Content-Length"])
    whole = lambda name: int(fields[name]) if name in fields else None
    return (
        whole("X-Record"),
        whole("X-Page"),
        fields.get("WARC-Target-URI"),
        fields["WARC-Type"],
        whole("X-Refers-To-Record"),
        whole("X-Refers-To-Page"),
        fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        rest[:size],
    )


def _gzip(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _write(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        out, at = None, 0

        def index():
            nonlocal out, at
            for record, page, url, digest, refers, refers_page, data in rows_of(batches):
                out = out or store.open_output_stream(f"{path}/{name}", compression=None)  # members are gzip already
                member = _gzip(to_record(record, page, url, digest, refers, refers_page, data, date))
                out.write(member)
                yield record, page, name, at, len(member), url, digest
                at += len(member)

        rows = list(batched(index(), _INDEX))  # index rows leave once their archive is complete
        if out:
            out.close()
        yield from rows

    return write


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html"):
    """Write one archive per task below ``folder``; returns the stored index.

    Of equal payloads of at least ``LEAST_REVISIT_BYTES`` the row with the smallest id (nulls
    last, then the first row) is the response and the others revisit it. A null body is empty. Repeated ids
    are rows of their own, each with its record number.
    """
    data = F.coalesce(F.col(body_col).cast("binary"), F.lit(b""))
    pages = fixed(
        pages,
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.sha2(data, 256).alias("payload_digest"),
        data.alias("data"),
    )
    rows = pages.withColumnRenamed(ROW, "record")
    order = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "record")
    long_enough = F.octet_length("data") >= LEAST_REVISIT_BYTES
    firsts = (
        rows.where(long_enough).select("payload_digest", "page_id", "record").groupBy("payload_digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    rows = rows.join(firsts, "payload_digest", "left")
    again = long_enough & (F.col("first.record") != F.col("record"))
    rows = rows.select(
        "record", "page_id", "url", "payload_digest",
        F.when(again, F.col("first.record")).alias("refers"),
        F.when(again, F.col("first.page_id")).alias("refers_page"),
        F.when(again, F.lit(b"")).otherwise(F.col("data")).alias("data"),
    )
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    index = stored(rows.mapInArrow(_write(folder), _INDEX_SQL), "warc-index")
    discard(pages)
    return index


def coalesced(ranges: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Reads ``(start, end, ranges)`` that cover sorted ranges with few gaps."""
    start = end = None
    own: list[tuple[int, int]] = []
    for offset, length in ranges:
        if own and (offset - end > NEAR_BYTES or offset + length - start > READ_BYTES):
            yield start, end, own
            own = []
        if not own:
            start, end = offset, offset
        own.append((offset, length))
        end = max(end, offset + length)
    if own:
        yield start, end, own


def _read(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)

        def records():
            name, source, waiting = None, None, []

            def flush():
                for start, end, own in coalesced(iter(waiting)):
                    source.seek(start)
                    raw = source.read(end - start)
                    for offset, length in own:
                        member = raw[offset - start : offset - start + length]
                        yield from_record(zlib.decompress(member, 31))
                waiting.clear()

            for archive, offset, length in rows_of(batches):
                if archive != name or len(waiting) >= 1024:
                    if waiting:
                        yield from flush()
                    if archive != name:
                        if source:
                            source.close()
                        name, source = archive, store.open_input_file(f"{path}/{archive}")
                waiting.append((offset, length))
            if waiting:
                yield from flush()
            if source:
                source.close()

        yield from batched(records(), _RECORDS, most=1024, weight=lambda r: len(r[7]))

    return read


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the index rows given: a selection by URL or digest is a filter on the index."""
    wanted = index.select("archive", "offset", "length")
    stretch = F.floor(F.col("offset") / STRETCH_BYTES)
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few index bytes stand for many read
    wanted = wanted.repartition(tasks, "archive", stretch).sortWithinPartitions("archive", "offset")
    return wanted.mapInArrow(_read(folder), _RECORDS_SQL)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("record", pa.int64()),
            ("page_id", pa.int64()),
            ("record_type", pa.string()),
            ("refers_to_record", pa.int64()),
            ("refers_to", pa.int64()),
            ("stated", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
        ]
    )

    def rows():
        for record, page, kind, refers, refers_page, stated, data in rows_of(batches):
            yield record, page, kind, refers, refers_page, stated, len(data), hashlib.sha256(data).hexdigest()

    yield from batched(rows(), schema)


def archive_report(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives, read all back and tell what each record holds.

    Size and digest come from the payload read; for a revisit, from the record it refers to.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    index = write_archives(pages, folder)
    records = read_records(index, folder).select(
        "record", "page_id", "record_type", "refers_to_record", "refers_to", "payload_digest", "payload"
    )
    kind = (
        "record long, page_id long, record_type string, refers_to_record long, refers_to long, stated string, "
        "payload_bytes long, payload_digest string"
    )
    found = stored(records.mapInArrow(_digests, kind), "records")
    own = found.where("record_type = 'response'")
    sources = own.select(F.col("record").alias("refers_to_record"), "payload_bytes", "payload_digest")
    again = found.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return own.select(names).unionByName(again.join(sources, "refers_to_record").select(names))
