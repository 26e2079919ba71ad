"""WARC archives that are compressed record by record with a dictionary of their own.

An archive begins with a skippable frame that holds its Zstandard dictionary, itself one
compressed frame; a frame for each record follows. The dictionary is trained on the archive's
first records, which wait for it in a bounded buffer. So every archive can be read alone, and every
record from its first byte on.

Tasks write their archives straight into the shared folder, under names that no other attempt
uses. Only what the written list of archives names counts: what a lost or repeated attempt
leaves behind is never read.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.text import pieces
from tillwise.staging import shared_folder, stage

#: Bytes of records, before compression, after which a task begins its next archive.
ARCHIVE_BYTES = 256 << 20
#: Bytes of an archive's first records that its dictionary is trained on.
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 6
#: Shorter payloads are never written as revisits.
LEAST_REVISIT = 1000

# The frame's magic number, the version line and the profile of a revisit.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_ID = re.compile(r"<urn:x-page:(-?\d+|null):[0-9a-f]{40}>")

_ARCHIVES = "path string, records long, raw_bytes long, bytes long, dictionary_bytes long"
_RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long,"
    " payload_digest string, payload binary"
)


# ------------------------------------------------------------------------ one record


def record_id(page: int | None, digest: bytes) -> str:
    """Pages with one id and one payload are one record, however often it is written."""
    return f"<urn:x-page:{'null' if page is None else page}:{digest.hex()}>"


def _escaped(url: str) -> str:
    """White space and control characters would end a header line; they are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response, or with ``refers_to`` a revisit of that page: it leaves the payload out, but keeps its head."""
    digest = hashlib.sha1(payload).digest()
    head = _HTTP.format(len(payload)).encode()
    body = head + payload if refers_to is None else head
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page, digest),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _escaped(url),
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(digest).decode()}",
        "WARC-Refers-To": None if refers_to is None else record_id(refers_to, digest),
        "WARC-Profile": None if refers_to is None else SAME_PAYLOAD,
        "Content-Type": "application/http; msgtype=response",
    }
    return _block(fields, body)


def _block(fields: dict[str, str | None], body: bytes) -> bytes:
    lines = [f"{k}: {v}".encode() for k, v in fields.items() if v is not None]
    lines.append(b"Content-Length: %d" % len(body))
    return b"\r\n".join([VERSION, *lines, b"", body, b"", b""])


# ------------------------------------------------------------------------- an archive


class ArchiveWriter:
    """Writes records to a stream, the first ones when there are enough for a dictionary."""

    def __init__(self, stream: BinaryIO, date: str, level: int = LEVEL, sample: int = SAMPLE_BYTES, dictionary: int = DICTIONARY_BYTES):
        self.stream, self.level, self.sample, self.dictionary = stream, level, sample, dictionary
        self.waiting: list[bytes] | None = []
        self.waiting_bytes = self.records = self.raw_bytes = self.bytes = self.dictionary_bytes = 0
        fields = {
            "WARC-Type": "warcinfo",
            "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
            "WARC-Date": date,
            "Content-Type": "application/warc-fields",
        }
        self._put(_block(fields, b"format: WARC file version 1.1\r\n"))

    def add(self, item: bytes) -> None:
        self.records += 1
        self._put(item)

    def _put(self, item: bytes) -> None:
        self.raw_bytes += len(item)
        if self.waiting is None:
            self._write(self.compressor.compress(item))
            return
        self.waiting.append(item)
        self.waiting_bytes += len(item)
        if self.waiting_bytes >= self.sample:
            self._begin()

    def _begin(self) -> None:
        """Train, write the dictionary's frame and what has waited for it."""
        waiting, self.waiting = self.waiting, None
        trained = train(waiting, self.dictionary)
        if trained is None:
            self.compressor = zstandard.ZstdCompressor(level=self.level, write_checksum=True)
        else:
            frame = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
            self.dictionary_bytes = len(frame)
            self._write(struct.pack("<II", DICTIONARY_FRAME, len(frame)) + frame)
            self.compressor = zstandard.ZstdCompressor(level=self.level, dict_data=trained, write_checksum=True)
        for item in waiting:
            self._write(self.compressor.compress(item))

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.waiting is not None:
            self._begin()
        self.stream.close()


def train(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of at most ``size`` bytes and an eighth of the samples; None where these are too few.

    The trainer's segments are as long as a usual line of markup and shared eight bytes at a time.
    """
    # a long record is cut: the trainer gains nothing from its middle
    parts = [x[i : i + (128 << 10)] for x in samples for i in range(0, len(x), 128 << 10)]
    size = min(size, sum(map(len, parts)) // 8)
    if len(parts) < 8 or size < 256:
        return None
    try:
        return zstandard.train_dictionary(size, parts, k=1024, d=8)
    except zstandard.ZstdError:
        # the library refuses samples without anything in common
        return None


def read_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and body of each record of an archive, in order."""
    start = stream.read(8)
    dictionary, before = None, start
    if len(start) == 8 and (found := struct.unpack("<II", start))[0] == DICTIONARY_FRAME:
        frame, before = stream.read(found[1]), b""
        dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(frame))
    source = io.BufferedReader(_Joined(before, stream), 1 << 20)
    plain = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(source, read_across_frames=True)
    lines = io.BufferedReader(plain, 1 << 20)
    while version := lines.readline():
        if version.strip() != VERSION:
            raise ValueError(f"no WARC record begins with {version[:40]!r}")
        fields = {}
        while (line := lines.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        body = lines.read(int(fields["Content-Length"]))
        if lines.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut short")
        yield fields, body


class _Joined(io.RawIOBase):
    """A few bytes that were read already, then the rest of a stream."""

    def __init__(self, first: bytes, rest: BinaryIO):
        self.first, self.rest = first, rest

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        data = self.first or self.rest.read(len(into))
        self.first, data = data[len(into) :], data[: len(into)]
        into[: len(data)] = data
        return len(data)


def page_of(fields: dict[str, str], body: bytes) -> tuple:
    """A row of :func:`read` from a response or revisit; checks a payload against its digest."""
    head, _, payload = body.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^Content-Length: (\d+)", head)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).digest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")

    def page(name: str) -> int | None:
        found = _ID.fullmatch(fields[name])[1] if name in fields else "null"
        return None if found == "null" else int(found)

    refers_to = page("WARC-Refers-To")
    kept = payload if kind == "response" else None
    return page("WARC-Record-ID"), fields.get("WARC-Target-URI"), kind, refers_to, size, digest.hex(), kept


# ------------------------------------------------------------------ the distributed parts


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id, url, html, refers_to``: the page whose equal payload a record may point to.

    Of payloads with equal SHA-256 and at least ``least`` bytes the one with the largest
    page_id is written, all others refer to it. Digests are grouped before they are joined, so
    a payload with very many copies is one row there; its copies' own rows are split by
    adaptive execution. Payloads that are too short are not shuffled.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    )
    size = F.octet_length("html")
    large = rows.where(size >= least).withColumn("_hash", F.unhex(F.sha2(F.col("html").cast("binary"), 256)))
    largest = (
        large.groupBy("_hash")
        .agg(F.max("page_id").alias("_largest"), F.count(F.lit(1)).alias("_copies"))
        .where("_copies > 1 AND _largest IS NOT NULL")
        .drop("_copies")
    )
    refers_to = F.when(~F.col("_largest").eqNullSafe(F.col("page_id")), F.col("_largest"))
    joined = large.join(largest, "_hash", "left").select("page_id", "url", "html", refers_to.alias("refers_to"))
    small = rows.where(size < least).withColumn("refers_to", F.lit(None).cast("long"))
    return joined.unionByName(small)


def _write_archives(folder: str, date: str, archive_bytes: int, sample: int, dictionary: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(folder)
        writer, path, done = None, None, []

        def finish() -> None:
            writer.close()
            done.append((path, writer.records, writer.raw_bytes, writer.bytes, writer.dictionary_bytes))

        for batch in batches:
            for piece in pieces(batch, "html"):
                payloads = piece.column("html").cast(pa.large_binary()).to_pylist()
                others = (piece.column(c).to_pylist() for c in ("page_id", "url", "refers_to"))
                for payload, page, url, refers_to in zip(payloads, *others, strict=True):
                    if writer is None:
                        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
                        path = f"{folder}/{name}"
                        writer = ArchiveWriter(system.open_output_stream(f"{place}/{name}"), date, level, sample, dictionary)
                    writer.add(record(page, url, payload, refers_to, date))
                    if writer.raw_bytes >= archive_bytes:
                        finish()
                        writer = None
        if writer is not None:
            finish()
        names = [x.split()[0] for x in _ARCHIVES.split(", ")]
        kinds = [pa.string(), *[pa.int64()] * 4]
        if done:
            columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def write(
    pages: DataFrame,
    folder: str | None = None,
    date: str | None = None,
    *,
    archive_bytes: int = ARCHIVE_BYTES,
    sample: int = SAMPLE_BYTES,
    dictionary: int = DICTIONARY_BYTES,
    level: int = LEVEL,
    least: int = LEAST_REVISIT,
) -> DataFrame:
    """Write ``page_id, url, html`` as archives and return the list of them.

    Columns: ``path, records, raw_bytes, bytes, dictionary_bytes``. ``folder`` is a URI that
    every executor can reach by pyarrow (file, hdfs, s3, gs); by default a new one in the
    shared folder. Runs when called. Every row becomes one record: a null html is an empty
    payload, a record of a null url has no target. Rows with one page_id and one payload are
    responses alike if no larger id has the payload. Rows without page_id refer to a page that
    has one, if any has their payload. A payload of any length is one record. No rows give no
    archives; other columns are not read. Archives with too few records to learn from
    have no dictionary.
    """
    spark = pages.sparkSession
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    if folder is None:
        folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    task = _write_archives(folder, date, archive_bytes, sample, dictionary, level)
    return stage(revisits(pages, least).mapInArrow(task, _ARCHIVES), "archives")


def _read_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    def frame(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in _RECORDS.split(", ")]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, place = fs.FileSystem.from_uri(path)
            rows, size = [], 0
            with system.open_input_stream(place) as stream:
                for fields, body in read_records(stream):
                    if fields["WARC-Type"] in ("response", "revisit"):
                        rows.append(page_of(fields, body))
                        size += len(body)
                    if size >= 4 << 20 or len(rows) >= 4096:
                        yield frame(rows)
                        rows, size = [], 0
            if rows:
                yield frame(rows)


def read(archives: DataFrame) -> DataFrame:
    """The records of the archives that ``path`` names.

    Columns: ``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload``; a
    revisit has the size and digest of the payload it leaves out. Archives are spread over the
    tasks and streamed; a payload that does not match its digest stops the job.
    """
    spark = archives.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return archives.select("path").repartition(tasks, "path").mapInArrow(_read_archives, _RECORDS)


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    written = write(spark.read.parquet(f"{folder}/pages.parquet"))
    return read(written).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle() -> str:
    return f"""
      WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
      m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS largest, strlen(html) AS size FROM p)
      SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
             CASE WHEN size >= {LEAST_REVISIT} AND page_id IS DISTINCT FROM largest AND largest IS NOT NULL
                  THEN 'revisit' ELSE 'response' END AS record_type,
             CASE WHEN size >= {LEAST_REVISIT} AND page_id IS DISTINCT FROM largest THEN largest END AS refers_to
      FROM m"""
