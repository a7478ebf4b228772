"""Legacy ARC archives to WARC, and WARC files written and read back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from shelfcast.llm.arrow import BATCH_BYTES
from shelfcast.llm.text import whole
from shelfcast.operators.joins import attach
from shelfcast.schema import N_ROWS
from shelfcast.session import cut_lineage, new_path, ship

# The field lists of the two ARC versions, as they stand in an archive's version block.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}

#: Bytes after which an archive file is closed; a larger record fills a file by itself.
ARCHIVE_BYTES = 8 << 20

#: Payloads of at least so many bytes are recorded once and revisited afterwards.
MIN_REVISIT_BYTES = 0

CRAWL_DATE = "20200101000000"
_ADDRESS = "0.0.0.0"
_KEY_HEADER = "X-Record-Key"
_END = b"\r\n\r\n"
_GZIP = b"\x1f\x8b"

#: Compression of archives: the intermediate ones and those kept.
_ARC_LEVEL, _WARC_LEVEL = 1, 3


def base32_sha1(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class _Files:
    """Records of one task packed into compressed files of at most ``limit`` bytes, a larger one alone."""

    def __init__(self, limit: int, level: int, start: Callable[[str], bytes], extension: str):
        from pyspark import TaskContext

        self.limit, self.level, self.start, self.extension = limit, level, start, extension
        self.task, self.count = TaskContext.get().partitionId(), 0
        self._open()

    def _open(self) -> None:
        self.name = f"{self.task:06d}-{self.count:05d}.{self.extension}"
        first = self.start(self.name)
        self.parts, self.size, self.records = [first], len(first), 0

    def closed(self) -> Iterator[pa.RecordBatch]:
        if self.records:
            content = gzip.compress(b"".join(self.parts), self.level, mtime=0)
            yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["archive"])
            self.count += 1
            self._open()

    def add(self, make: Callable[[str, int], bytes]) -> Iterator[pa.RecordBatch]:
        """The record that ``make`` gives for the file's name and size; yields a file that is full."""
        record = make(self.name, self.size)
        if self.records and self.size + len(record) > self.limit:
            yield from self.closed()
            record = make(self.name, self.size)
        self.parts.append(record)
        self.size += len(record)
        self.records += 1


_ARCHIVE = StructType([StructField("archive", BinaryType())])


def _write_files(archives: DataFrame, path: str) -> None:
    """One file a row through Spark's own writer, so they reach whatever store Spark does; the zero byte at
    the end is padding to a gzip reader."""
    values = archives.select(F.col("archive").cast("string").alias("value"))
    values.write.option("maxRecordsPerFile", 1).option("lineSep", "\0").option("compression", "none").text(path)


# --- ARC ------------------------------------------------------------------------------------------


def _arc_version_block(name: str, version: str) -> bytes:
    body = f"{version} 0 local\n{ARC_FIELDS[version]}\n\n".encode()
    fields = [f"filedesc://{name}", _ADDRESS, CRAWL_DATE, "text/plain"]
    middle = [] if version == "1" else ["200", "-", "-", "0", name]
    return " ".join([*fields, *middle, str(len(body))]).encode() + b"\n" + body + b"\n"


def _arc_record(url: str, block: bytes, version: str, name: str, offset: int) -> bytes:
    fields = [re.sub(r"[\s\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url) or "-", _ADDRESS, CRAWL_DATE, "text/html"]
    middle = [] if version == "1" else ["200", hashlib.md5(block).hexdigest(), "-", str(offset), name]
    return " ".join([*fields, *middle, str(len(block))]).encode() + b"\n" + block + b"\n"


def write_arc(pages: DataFrame, path: str, key: str, url: str, body: str, version: str = "2", limit: int = ARCHIVE_BYTES) -> None:
    """One ARC record per row under ``path``: an HTTP response with the body in UTF-8 (null: empty).

    The key goes into a header field, so it comes back with the record. Each task packs its own rows into
    files of at most ``limit`` bytes before compression; every file starts with its version block.
    """
    ship(pages.sparkSession)
    pages.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    slim = pages.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{url}`").alias("url"), whole(F.col(f"`{body}`")).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(limit, _ARC_LEVEL, lambda name: _arc_version_block(name, version), "arc")
        for batch in batches:
            for key_text, address, page in zip(*(c.to_pylist() for c in batch.columns)):
                payload = page.encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
                if key_text is not None:
                    head += f"{_KEY_HEADER}: {key_text}\r\n"
                block = head.encode() + b"\r\n" + payload
                yield from files.add(lambda name, size: _arc_record(address or "", block, version, name, size))
        yield from files.closed()

    _write_files(slim.mapInArrow(run, _ARCHIVE), path)


def parse_arc(content: bytes) -> Iterator[tuple[str, str, str, bytes]]:
    """(url, 14-digit date, content type, block) of every record after the version block.

    The version block names the version, which decides the fields of a header line; a record ends where
    its declared length does. Damage raises, since nothing after it can be trusted.
    """
    at, fields = 0, None
    while at < len(content):
        if content[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = content.index(b"\n", at)
        values = content[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        length = int(values[-1])
        block = content[end + 1 : end + 1 + length]
        if len(block) != length:
            raise ValueError(f"record at {at} declares {length} bytes and has {len(block)}")
        if fields is None:
            if not values[0].startswith("filedesc:"):
                raise ValueError("an archive starts with its version block")
            version = block.split(b" ", 1)[0].decode()
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown archive version {version!r}")
            fields = ARC_FIELDS[version].split(" ")
        elif len(values) < len(fields):
            raise ValueError(f"record at {at} has {len(values)} fields, not {len(fields)}")
        else:
            # The URL is the one field that may hold spaces in archives of careless writers.
            values = [" ".join(values[: len(values) - len(fields) + 1]), *values[len(values) - len(fields) + 1 :]]
            named = dict(zip(fields, values))
            yield named["URL"], named["Archive-date"], named["Content-type"], block
        at = end + 1 + length


_PLACES = [StructField(n, LongType() if n in ("place", "n_bytes") else StringType()) for n in ("archive", "place", "key", "url", "date", "digest", "n_bytes")]
PLACES = StructType(_PLACES)
RECORDS = StructType([*_PLACES, StructField("http", BinaryType()), StructField("payload", BinaryType())])


def _split_http(block: bytes) -> tuple[bytes, bytes, str | None]:
    """(HTTP header with its empty line, payload, record key if the header names one)."""
    at = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") else -1
    if at < 0:
        return b"", block, None
    head = block[: at + 4]
    key = re.search(rb"^" + _KEY_HEADER.encode() + rb": ([^\r\n]*)\r$", head, re.M)
    return head, block[at + 4 :], key[1].decode() if key else None


def _read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")


def _map_files(files: DataFrame, parse, schema: StructType) -> DataFrame:
    ship(files.sparkSession)
    files.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    types = [kinds[f.dataType.simpleString()] for f in schema]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                content = batch.column(1)[i].as_py()
                content = gzip.decompress(content) if content[:2] == _GZIP else content
                for row in parse(batch.column(0)[i].as_py(), content):
                    rows.append(row)
                    size += sum(len(x) for x in row if isinstance(x, (bytes, str)))
                    if size >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return files.mapInArrow(run, schema)


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """archive, place, key, url, date, digest and length of the payload of every record below ``path``, and
    unless ``payloads`` is false the HTTP header and the payload."""

    def parse(file: str, content: bytes) -> Iterator[tuple]:
        for place, (url, date, _, block) in enumerate(parse_arc(content)):
            http, payload, key = _split_http(block)
            known = file, place, key, url, date, base32_sha1(payload), len(payload)
            yield (*known, http, payload) if payloads else known

    return _map_files(_read_files(spark, path), parse, RECORDS if payloads else PLACES)


# --- WARC -----------------------------------------------------------------------------------------


def _record_id() -> Column:
    identity = F.md5(F.concat_ws(" ", "archive", "place"))
    uuid = F.concat_ws("-", *[F.substring(identity, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))


def repeated_payloads(places: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(digest, n_bytes, n_rows, first) of the payloads of at least ``min_bytes`` bytes that occur twice or more.

    ``first`` is the record with the smallest key (as a number; keyless ones last, then by place). Tasks
    reduce their records to one row a payload before any is moved. The table is stored, so that Spark knows
    its bytes.
    """
    number = F.expr("try_cast(key AS BIGINT)")
    order = F.struct(number.isNull().alias("unknown"), number.alias("number"), "key", "archive", "place", _record_id().alias("id"), "url")
    counted = places.where(F.col("n_bytes") >= min_bytes).groupBy("digest", "n_bytes").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias(N_ROWS))
    return cut_lineage(counted.where(F.col(N_ROWS) > 1))


def warc_records(records: DataFrame, repeated: DataFrame) -> DataFrame:
    """The columns of ``records`` with WARC identifier, date, type, and the record referred to.

    Of records with equal payloads (equal digest and length) the first is the response and the others
    revisit it; payloads that ``repeated`` does not name are all responses. Records of a payload that is
    very common are spread over tasks where the join has to move them.
    """
    stamp = F.regexp_replace("date", r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6Z")
    known = records.select("*", _record_id().alias("id"), stamp.alias("stamp"))
    joined = attach(known, repeated, ["digest", "n_bytes"], weights=repeated, how="left")
    revisits = F.col("first").isNotNull() & (F.col("first.id") != F.col("id"))
    return joined.select(
        *known.columns,
        F.when(revisits, "revisit").otherwise("response").alias("type"),
        F.when(revisits, F.col("first.id")).alias("refers_to_id"),
        F.when(revisits, F.col("first.url")).alias("refers_to_url"),
        F.when(revisits, F.col("first.key")).alias("refers_to_key"),
    )


def _warc_record(row: dict) -> bytes:
    """A revisit keeps the HTTP header and leaves out the payload; its digest and length stay in its fields."""
    revisit = row["type"] == "revisit"
    block = row["http"] if revisit else row["http"] + row["payload"]
    fields = {
        "WARC-Type": row["type"],
        "WARC-Record-ID": row["id"],
        "WARC-Date": row["stamp"],
        "WARC-Target-URI": row["url"],
        "WARC-Payload-Digest": f"sha1:{row['digest']}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
        "WARC-Refers-To": row["refers_to_id"],
        "WARC-Refers-To-Target-URI": row["refers_to_url"],
        "X-Refers-To-Key": row["refers_to_key"],
        "X-Payload-Length": str(row["n_bytes"]),
        "Content-Type": "application/http; msgtype=response" if row["http"] else "application/octet-stream",
        "Content-Length": str(len(block)),
    }
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    return head.encode() + b"\r\n" + block + _END


def write_warc(records: DataFrame, path: str, limit: int = ARCHIVE_BYTES) -> None:
    """WARC 1.1 files from :func:`warc_records`, their records ended by two empty lines.

    Each task closes a file before it grows over ``limit`` bytes, so only a record that is larger itself
    makes a larger file.
    """
    ship(records.sparkSession)
    records.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(limit, _WARC_LEVEL, lambda name: b"", "warc")
        for batch in batches:
            for row in batch.to_pylist():
                record = _warc_record(row)
                yield from files.add(lambda name, size: record)
        yield from files.closed()

    _write_files(records.mapInArrow(run, _ARCHIVE), path)


_READ = [StructField(n, StringType()) for n in ("id", "type", "date", "url", "payload_digest", "refers_to_id", "refers_to_key", "key")]
DESCRIBED = StructType([*_READ, StructField("payload_bytes", LongType())])
READ = StructType([*DESCRIBED.fields, StructField("payload", BinaryType())])


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-cased name, block) of every record, by its declared length."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        length = int(fields["content-length"])
        block = content[end + 4 : end + 4 + length]
        at = end + 4 + length + 4
        if len(block) != length or content[at - 4 : at] != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} does not end where it declares")
        yield fields, block


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the WARC files below ``path``, without their payloads if ``payloads`` is false. A response's
    payload is checked against its digest."""

    def parse(_: str, content: bytes) -> Iterator[tuple]:
        for fields, block in parse_warc(content):
            _, payload, key = _split_http(block)
            digest, response = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"] == "response"
            if response and base32_sha1(payload) != digest:
                raise ValueError(f"record {fields['warc-record-id']} has another payload than its digest")
            described = (
                fields["warc-record-id"],
                fields["warc-type"],
                fields["warc-date"],
                fields.get("warc-target-uri"),
                digest,
                fields.get("warc-refers-to"),
                fields.get("x-refers-to-key"),
                key,
                len(payload) if response else int(fields["x-payload-length"]),
            )
            yield (*described, payload if response else None) if payloads else described

    return _map_files(_read_files(spark, path), parse, READ if payloads else DESCRIBED)


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """The ARC archives below ``arc_path`` as WARC files below ``warc_path``, revisits found.

    The archives are read twice: for digests and places alone, and for the records. Payloads are written by
    the tasks that read them unless the table of repeated payloads is too large to be sent to each.
    """
    repeated = repeated_payloads(read_arc(spark, arc_path, payloads=False), min_bytes)
    write_warc(warc_records(read_arc(spark, arc_path), repeated), warc_path)


def archived_pages(
    pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", version: str = "2", payloads: bool = True
) -> DataFrame:
    """Pages through a legacy archive, its conversion to WARC and back: the rows of :func:`read_warc`.

    Null bodies are empty payloads, null keys stay null, null URLs are written as ``-``, repeated rows are
    records of their own of which one is the response. Other columns are not looked at. Files are bounded
    by bytes, as reading takes a whole file into a task; a page beyond the bound is a file by itself. An
    empty table gives no records.
    """
    spark = pages.sparkSession
    arc, out = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(pages, arc, key, url, body, version)
    convert(spark, arc, out)
    return read_warc(spark, out, payloads)
