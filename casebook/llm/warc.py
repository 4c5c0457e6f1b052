"""Web archives (WARC): an index of every record first, then coalesced byte-range reads of selected records.

``write_archive`` writes one record for each page, each a gzip member of its own, into archive files of about
``file_bytes``. Every task writes its own files, under names no other attempt uses, and returns one index row for each
record: file, offset, length, URL, payload digest and length, and what the record is. Spark commits those rows as the
index; files of lost or repeated attempts are in no index row, and ``orphans`` lists them. Pages of equal payload (by
SHA-256 and length) get one ``response`` record, the others are ``revisit`` records that name it. The choice is a
maximum that is combined before the shuffle, so one payload may be shared by any share of the pages.

``read_records`` starts from the index: it selects rows, sorts their byte ranges by file and offset, and merges ranges
that are at most ``gap`` bytes apart into reads of about ``read_bytes``. A read fetches just its bytes; records are cut
at their indexed places, parsed and checked: declared lengths, and the digest of a response's payload. What is wrong is
raised, not skipped. Payloads move once at most, to meet the choice of their group; reading shuffles index rows only.

Archives lie where ``pyarrow.fs`` and Spark both reach them (a shared mount, HDFS, an object store).

Edge cases: null html counts as empty; pages with null page_id are archived (smaller than all others in the choice of
the response); a repeated row is a record of its own, and of rows that share the largest page_id one is the response;
a null or empty url becomes ``about:blank`` in the archive and stays as it is in the index; characters of a url that
aren't printable ASCII are percent-encoded in the archive; payloads may hold anything; an empty table gives an empty
index; further columns are ignored. With ``least``, pages of shorter payload are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm.frames import shared_path, stored

CRLF = "\r\n"
END = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, url string, payload_digest string, payload_bytes long, page_id long, record_type string, refers_to long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


@dataclass(frozen=True)
class Archive:
    """Where an archive lies: its index (a Parquet table) and the folder of its files."""

    index: str
    files: str


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, ARROW[t]) for n, t in (f.split() for f in ddl.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _store(path: str):
    """(file system, path) of a Spark path."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


# --- records ---


def sha1_label(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def target(url: str | None) -> str:
    """The URL as it may stand in a header line."""
    if not url:
        return "about:blank"
    return url if re.fullmatch(r"[!-~]+", url) else quote(url, safe="!#$%&'()*+,-./:;=?@[]_~")


def _record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _head(first: str, fields: list[tuple[str, object]]) -> bytes:
    return (first + CRLF + "".join(f"{k}: {v}{CRLF}" for k, v in fields if v is not None) + CRLF).encode()


def info_record(name: str, date: str) -> bytes:
    body = _head("software: casebook", [("format", "WARC File Format 1.1")])[:-2]
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(name)), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", len(body))]
    return _head("WARC/1.1", fields) + body + END


def page_record(name: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers: tuple | None, date: str) -> bytes:
    """A response record, or a revisit record if ``refers`` = (page_id, record name) is given: it has the HTTP head alone."""
    block = _head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    if refers is None:
        block += payload
    fields = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", _record_id(name)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", refers and IDENTICAL),
        ("WARC-Refers-To", refers and _record_id(refers[1])),
        ("X-Page-Id", page_id),
        ("X-Refers-To-Page-Id", refers and refers[0]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    return _head("WARC/1.1", fields) + block + END


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split(CRLF)[1:])


def parse_record(member: bytes) -> tuple:
    """One page record's gzip member as a row of ``RECORD``; raises ValueError where it doesn't hold together."""
    gz = zlib.decompressobj(31)
    try:
        raw = gz.decompress(member) + gz.flush()
    except zlib.error as e:
        raise ValueError(f"no gzip member at the indexed place: {e}") from e
    head, _, rest = raw.partition(END)
    if not gz.eof or gz.unused_data or not head.startswith(b"WARC/1."):
        raise ValueError(f"no WARC record at the indexed place: {raw[:80]!r}")
    fields = _fields(head)
    n = int(fields["Content-Length"])
    if rest[n:] != END:
        raise ValueError(f"wrong length of {fields['WARC-Record-ID']}")
    http, _, body = rest[:n].partition(END)
    size, digest, kind = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(body) != size or sha1_label(body) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    page, refers = (int(fields[k]) if k in fields else None for k in ("X-Page-Id", "X-Refers-To-Page-Id"))
    return page, fields["WARC-Target-URI"], size, digest, kind, refers, body if kind == "response" else None


# --- writing ---


def _writer(folder: str, file_bytes: int, date: str, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = _schema(INDEX)

    def member(record: bytes) -> bytes:
        gz = zlib.compressobj(level, zlib.DEFLATED, 31)
        return gz.compress(record) + gz.flush()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _store(folder)
        out, name, at = None, None, 0
        for b in batches:
            rows = []
            for k in range(len(b)):
                page, url, payload, own, refers, refers_row = (b[c][k].as_py() for c in ("page_id", "url", "payload", "row_id", "refers_to", "refers_row"))
                payload = payload.encode()
                if out is None or at >= file_bytes:
                    if out:
                        out.close()
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    first = member(info_record(name, date))
                    out.write(first)
                    at = len(first)
                digest = sha1_label(payload)
                data = member(page_record(own, page, url, payload, digest, (refers, refers_row) if refers_row is not None else None, date))
                out.write(data)
                rows.append((name, at, len(data), url, digest, len(payload), page, "response" if refers_row is None else "revisit", refers))
                at += len(data)
            if rows:
                yield _batch(rows, schema)
        if out:
            out.close()

    return write


def write_archive(
    pages: DataFrame, path: str | None = None, *, row_id: Column | None = None, least: int = 0, file_bytes: int = 256 << 20, date: str = DATE, level: int = 6
) -> Archive:
    """Archive ``pages`` (page_id, url, html) under ``path`` (a new folder in the shared one by default).

    ``row_id`` names a row in every reading of ``pages`` (a string, unique). Without it the pages are written once
    to fix such names.
    """
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    out = Archive(f"{path}/index", f"{path}/files")
    columns = [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload")]
    if row_id is None:
        rows = stored(pages.select(F.monotonically_increasing_id().cast("string").alias("row_id"), *columns), "warc-pages")
    else:
        rows = pages.select(row_id.cast("string").alias("row_id"), *columns)
    key = ["sha256", "payload_bytes"]
    rows = rows.withColumns({"sha256": F.unhex(F.sha2(F.col("payload").cast("binary"), 256)), "payload_bytes": F.octet_length("payload").cast("long")})
    groups = rows.where(F.col("payload_bytes") >= least).groupBy(*key).agg(F.count("*").alias("n"), F.max(F.struct("page_id", "row_id")).alias("first"))
    typed = rows.join(groups.where("n > 1").drop("n"), key, "left")
    later = F.col("first.row_id") != F.col("row_id")  # null where the payload is alone
    typed = typed.select("page_id", "url", "payload", "row_id", F.when(later, F.col("first.page_id")).alias("refers_to"), F.when(later, F.col("first.row_id")).alias("refers_row"))
    system, root = _store(out.files)
    system.create_dir(root)
    typed.mapInArrow(_writer(out.files, file_bytes, date, level), INDEX).write.option("compression", "zstd").parquet(out.index)
    return out


def archive_files(spark: SparkSession, archive: Archive) -> DataFrame:
    """(file, bytes) of what lies in the archive's folder."""
    files = spark.read.format("binaryFile").load(archive.files)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))


def orphans(spark: SparkSession, archive: Archive) -> DataFrame:
    """(file, bytes) that no index row names: left by attempts that were lost or ran twice."""
    return archive_files(spark, archive).join(spark.read.parquet(archive.index).select("file").distinct(), "file", "left_anti")


def broken(spark: SparkSession, archive: Archive) -> DataFrame:
    """(file, ends, bytes) of indexed files that are missing or of another size than their index rows say."""
    ends = spark.read.parquet(archive.index).groupBy("file").agg(F.max(F.col("offset") + F.col("length")).alias("ends"))
    return ends.join(archive_files(spark, archive), "file", "left").where("bytes IS NULL OR bytes <> ends")


# --- reading ---


def plan_reads(selected: DataFrame, *, gap: int = 64 << 10, read_bytes: int = 8 << 20) -> DataFrame:
    """(file, start, stop, records): the byte ranges of the selected index rows, sorted and merged.

    A read ends where more than ``gap`` unwanted bytes follow, or with the last record that starts in the same
    ``read_bytes`` of the file. Its list of records is bounded by those bytes.
    """
    order = Window.partitionBy("file").orderBy("offset")
    cell = F.floor(F.col("offset") / read_bytes)
    ends = F.max(F.col("offset") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("offset") - ends > gap) | (F.lag(cell).over(order) != cell), F.lit(True))
    numbered = selected.select("file", "offset", "length", fresh.cast("long").alias("fresh")).withColumn("read", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("file", "read").agg(
        F.min("offset").alias("start"),
        F.max(F.col("offset") + F.col("length")).alias("stop"),
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"),
    )


def _reader(folder: str, schema: pa.Schema, batch_bytes: int = 4 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _store(folder)
        rows, held = [], 0
        for reads in batches:
            for file, start, stop, records in zip(*(reads[c].to_pylist() for c in ("file", "start", "stop", "records"))):
                with system.open_input_file(f"{root}/{file}") as f:
                    data = f.read_at(stop - start, start)
                for x in records:
                    a = x["offset"] - start
                    row = parse_record(data[a : a + x["length"]])
                    rows.append(row[: len(schema)])
                    held += row[2]
                    if held > batch_bytes:
                        yield _batch(rows, schema)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    return read


def read_records(
    spark: SparkSession, archive: Archive, selected: DataFrame | None = None, *, payload: bool = True, gap: int = 64 << 10, read_bytes: int = 8 << 20, task_bytes: int = 128 << 20
) -> DataFrame:
    """The records of the ``selected`` index rows (all by default), read back from the archive files.

    Columns as in ``RECORD``; a revisit has no payload of its own. Without ``payload`` that column is left out. The
    reads are dealt to tasks of about ``task_bytes``, as few index rows may stand for many bytes.
    """
    selected = spark.read.schema(INDEX).parquet(archive.index) if selected is None else selected
    reads = stored(plan_reads(selected, gap=gap, read_bytes=read_bytes), "warc-reads")
    total = reads.agg(F.sum(F.col("stop") - F.col("start"))).first()[0] or 0
    ddl = RECORD if payload else RECORD.rsplit(", ", 1)[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    return reads.repartition(tasks).mapInArrow(_reader(archive.files, _schema(ddl)), ddl)


def digest(spark: SparkSession, pages: DataFrame, *, row_id: Column | None = None, least: int = 0) -> DataFrame:
    """Archive ``pages`` and read every record back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    archive = write_archive(pages, row_id=row_id, least=least)
    out = read_records(spark, archive, payload=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
