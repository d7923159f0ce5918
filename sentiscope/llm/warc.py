"""Operator 12: WARC archives; a normaliser of files that are one gzip stream as a whole.

``write_archives`` writes pages as WARC files that are compressed as a whole (the form that
cannot be entered at a record).  ``normalise`` inflates such a file once, as a stream, rewrites every record
as a gzip member of its own and writes an index of offsets beside it.  ``read_records`` goes
by the index: any task can seek to any record, so one archive is read by many tasks.

Files lie in a folder that all executors reach, named by a path or a URI that Arrow's file
systems know (``file``, ``hdfs``, ``s3``, ``gs``).  Every attempt of a task writes files of its own names and
reports them; the reported rows are stored as a manifest before anyone reads, so what a lost or repeated
attempt left behind is never read.  A task holds one chunk of a record while it rewrites, and
one record while it reads.

Copies: of records with equal payloads of at least ``least`` bytes the one with the largest page id is a
response and the others revisit it.  Rows that repeat the largest id are all responses; a null id is smaller than
any other, and if a group has no other, all are responses (nothing could name what they revisit).  Null html is an
empty payload; a null url gives a record without target; control characters in a url are percent-encoded; an empty table
gives no files and no records.  A truncated or damaged archive raises an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiscope.llm.common import materialise, ship
from sentiscope.session import scratch_path

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20      # records of an archive before compression; then a new file begins
READ_SPAN = 8 << 20            # compressed bytes of an archive that one task reads
PIECE = 1 << 20                # bytes copied at a time
YIELD_BYTES = 16 << 20         # payloads handed to Spark at a time
END = b"\r\n"
MANIFEST = "path string, records long, bytes long"
INDEX = "path string, offset long, length long, record_id string, record_type string"
RECORD = ("record_id string, record_type string, refers_to string, page_id string, url string, digest string, "
          "payload binary")
# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ------------------------------------------------------------------- records
def record_id(page_id, digest: str) -> str:
    """The same page and payload get the same id on every rerun."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _header_lines(fields: list[tuple[str, str | None]]) -> bytes:
    return END.join([VERSION.encode(), *(f"{k}: {v}".encode() for k, v in fields if v is not None)]) + END + END


def _record(page_id, url, payload: bytes, digest: str, head, date: str) -> bytes:
    """One response, or a revisit of ``head``'s response without payload."""
    revisit = head is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = _header_lines([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else quote(url, safe="".join(map(chr, range(33, 127))))),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Refers-To", record_id(head, digest) if revisit else None),
        ("WARC-Profile", SAME_PAYLOAD if revisit else None),
        ("Page-ID", None if page_id is None else str(page_id)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ])
    return lines + block + END + END


def _read_header(stream) -> tuple[bytes, dict[str, str]] | None:
    """The next record's header as it is, and its fields (names in lower case); None at the end of the stream."""
    lines, fields = [stream.readline()], {}
    if not lines[0]:
        return None
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"no WARC record at {lines[0][:40]!r}")
    while True:
        lines.append(stream.readline())
        if not lines[-1].endswith(b"\n"):
            raise ValueError("archive ends within a record's header")
        if not lines[-1].strip():
            return b"".join(lines), fields
        name, _, value = lines[-1].decode("utf-8").partition(":")
        fields[name.strip().lower()] = value.strip()


def _take(stream, n: int) -> Iterator[bytes]:
    """The next ``n`` bytes in pieces."""
    while n:
        piece = stream.read(min(n, PIECE))
        if not piece:
            raise ValueError("archive ends within a record")
        n -= len(piece)
        yield piece


# --------------------------------------------------------------------- write
def with_heads(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, head``: ``head`` is the page whose response the row revisits, else null.

    Copies are counted on digests alone; only digests of several rows are joined back, and a
    digest of very many rows is split by the adaptive skew join (its other side has one row).
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    copies = (pages.select("page_id", payload.alias("payload")).where(F.octet_length("payload") >= least)
              .groupBy(F.sha1("payload").alias("digest"))
              .agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) & F.col("head").isNotNull()).select("digest", "head"))
    # an id equal to the head's keeps its payload
    return rows.join(copies, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("page_id").eqNullSafe(F.col("head")), None).otherwise(F.col("head")).alias("head"))


def write_archives(rows: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write each partition as WARC files, each one gzip stream; returns their manifest (``path, records, bytes``)."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, place = arrow_fs.FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)
        path = sink = packer = None
        size = count = 0

        def closed() -> pd.DataFrame:
            sink.write(packer.flush())
            done = pd.DataFrame({"path": [path], "records": [count], "bytes": [sink.tell()]})
            sink.close()
            return done

        for pdf in batches:
            for page_id, url, payload, digest, head in pdf.itertuples(index=False, name=None):
                if sink is None:
                    path = f"{place.rstrip('/')}/pages-{uuid.uuid4().hex}.warc.gz"
                    sink, packer = files.open_output_stream(path, compression=None), zlib.compressobj(1, zlib.DEFLATED, 31)
                record = _record(_plain(page_id), url, payload, digest, _plain(head), date)
                sink.write(packer.compress(record))
                size, count = size + len(record), count + 1
                if size >= archive_bytes:
                    yield closed()
                    sink, size, count = None, 0, 0
        if sink is not None:
            yield closed()

    # ids as text: pandas would turn whole numbers beside nulls into floats
    ready = rows.select(F.col("page_id").cast("string"), F.col("url").cast("string"), "payload", "digest", F.col("head").cast("string"))
    ship(__name__)
    return materialise(ready.mapInPandas(write, MANIFEST), "warc-manifest")


def _plain(value):
    return None if value is None or value is pd.NA or value != value else value


# ----------------------------------------------------------------- normalise
def rewrite_stream(source, sink) -> Iterator[dict]:
    """Copy the records of a gzip stream (whole-file or not) to ``sink`` as members; yields index entries.

    Memory: one piece of a record, and its header.
    """
    at = 0

    def put(data: bytes) -> None:
        nonlocal at
        sink.write(data)
        at += len(data)

    with gzip.GzipFile(fileobj=source, mode="rb") as stream:
        while (header := _read_header(stream)) is not None:
            start, packer = at, zlib.compressobj(6, zlib.DEFLATED, 31)
            lines, fields = header
            put(packer.compress(lines))
            for piece in _take(stream, int(fields["content-length"])):
                put(packer.compress(piece))
            for piece in _take(stream, 4):
                if piece.strip():
                    raise ValueError("record longer than its Content-Length")
                put(packer.compress(piece))
            put(packer.flush())
            yield {"offset": start, "length": at - start, "record_id": fields.get("warc-record-id"),
                   "record_type": fields.get("warc-type")}


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """Rewrite every archive of the manifest record by record, one task per archive; returns the new manifest.

    Beside each new file lies its index, ``<file>.idx``: a JSON line per record.
    """
    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                files, place = arrow_fs.FileSystem.from_uri(folder)
                files.create_dir(place, recursive=True)
                target, count = f"{place.rstrip('/')}/records-{uuid.uuid4().hex}.warc.gz", 0
                with (files.open_input_stream(path, compression=None) as source,
                      files.open_output_stream(target, compression=None) as sink,
                      files.open_output_stream(f"{target}.idx", compression=None) as index):
                    for entry in rewrite_stream(source, sink):
                        index.write(json.dumps(entry).encode() + b"\n")
                        count += 1
                    size = sink.tell()
                yield pd.DataFrame({"path": [target], "records": [count], "bytes": [size]})

    n = max(1, manifest.count())
    ship(__name__)
    return materialise(manifest.repartition(n).mapInPandas(rewrite, MANIFEST), "warc-manifest")


# ---------------------------------------------------------------------- read
def read_index(manifest: DataFrame, folder: str) -> DataFrame:
    """``path, offset, length, record_id, record_type`` of every record of the normalised archives."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, _ = arrow_fs.FileSystem.from_uri(folder)
        for pdf in batches:
            for path in pdf["path"]:
                with files.open_input_stream(f"{path}.idx", compression=None) as index:
                    rest = b""
                    while piece := index.read(PIECE):
                        *lines, rest = (rest + piece).split(b"\n")
                        if lines:
                            found = pd.DataFrame([json.loads(x) for x in lines])
                            yield found.assign(path=path)[["path", "offset", "length", "record_id", "record_type"]]

    ship(__name__)
    return manifest.mapInPandas(read, INDEX)


def read_tasks(manifest: DataFrame) -> int:
    """A task for every ``READ_SPAN`` of the archives."""
    total = manifest.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / F.lit(READ_SPAN))), F.lit(0))).first()[0]
    return max(1, int(total))


def _parse_member(data: bytes) -> tuple:
    stream = io.BytesIO(zlib.decompress(data, 31))
    _, fields = _read_header(stream)
    block = stream.read(int(fields["content-length"]))
    payload = block.partition(END + END)[2] if fields["warc-type"] == "response" else None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    digest = base64.b32decode(digest).hex() if digest else None
    if payload is not None and digest is not None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
    return (fields.get("warc-record-id"), fields["warc-type"], fields.get("warc-refers-to"), fields.get("page-id"),
            fields.get("warc-target-uri"), digest, payload)


def read_records(index: DataFrame, folder: str, tasks: int | None = None) -> DataFrame:
    """The records at the index's places: each task seeks into its share of the archives.

    ``tasks``: see :func:`read_tasks`; the index alone is too small to tell the work behind it.
    """
    names = [f.split()[0] for f in RECORD.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, _ = arrow_fs.FileSystem.from_uri(folder)
        for pdf in batches:
            for path, part in pdf.groupby("path", sort=False):
                with files.open_input_file(path) as source:
                    held, size = [], 0
                    for offset, length in zip(part["offset"], part["length"]):
                        source.seek(int(offset))
                        held.append(_parse_member(source.read(int(length))))
                        size += len(held[-1][-1] or b"")
                        if size > YIELD_BYTES:
                            yield pd.DataFrame(held, columns=names)
                            held, size = [], 0
                    if held:
                        yield pd.DataFrame(held, columns=names)

    span = (F.col("offset") / F.lit(READ_SPAN)).cast("long")
    places = (index.repartition(tasks, "path", span) if tasks else index.repartition("path", span))
    places = places.sortWithinPartitions("path", "offset")
    ship(__name__)
    return places.select("path", "offset", "length").mapInPandas(read, RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``: revisits get their response's size and page.

    Only revisits meet the join; those of one response are split by the adaptive skew join (one row on the other side).
    """
    found = records.where(F.col("record_type").isin("response", "revisit")).select(
        "record_id", "record_type", "refers_to", "page_id", "digest", F.octet_length("payload").cast("long").alias("n_bytes"))
    found = materialise(found, "warc-records")
    responses = (found.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to"))
                 .agg(F.max("page_id").alias("of"), F.max("n_bytes").alias("of_bytes")))
    whole = found.where("record_type = 'response'").select("page_id", "n_bytes", "digest", "record_type", F.lit(None).cast("string"))
    again = (found.where("record_type = 'revisit'").join(responses, "refers_to", "left")
             .select("page_id", "of_bytes", "digest", "record_type", "of"))
    return whole.union(again).toDF("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages written, normalised, and read back from the archives; ids have their type again."""
    spark: SparkSession = pages.sparkSession
    folder = folder or scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    written = write_archives(with_heads(pages), f"{folder}/whole")
    kept = normalise(written, f"{folder}/records")
    rows = resolve_revisits(read_records(read_index(kept, folder), folder, read_tasks(kept)))
    kind = pages.schema["page_id"].dataType
    return rows.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})


# DuckDB has sha1 over text as hex; the contract's roles are plain SQL.
WARC_SQL = f"""
WITH p AS (SELECT page_id, COALESCE(html, '') AS body FROM pages),
d AS (SELECT page_id, sha1(body) AS payload_digest, CAST(strlen(body) AS BIGINT) AS payload_bytes FROM p),
h AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS head FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND head IS NOT NULL AND page_id IS DISTINCT FROM head THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND head IS NOT NULL AND page_id IS DISTINCT FROM head THEN head END AS refers_to
FROM h
"""
