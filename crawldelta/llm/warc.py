"""WARC archives: written as whole-file gzip, normalised to one gzip member a record with a sidecar index, read by offset.

Spark's text sink writes the first archives, so they are committed by task on
any store. The normaliser inflates each of them once as a stream, a megabyte at
a time however long its records are, and writes two files through pyarrow's file
systems (local and mounted folders, HDFS, S3, GCS):

  <name>.warc.gz               every record a gzip member of its own
  <name>.warc.gz.index.jsonl   a line per record: archive, offset, length (of the member), inflated
                               and the header's record_id, record_type, target_uri, payload_digest, refers_to

Both are written under another name first and then renamed, the index last; a
task that runs again writes the same bytes under the same names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawldelta.llm import scratch
from crawldelta.llm.scratch import new_folder, ship_code, stored

#: Payloads of at least this many bytes are written once; equal ones revisit the first.
MIN_BYTES = 0

#: Records of one archive at most.
ARCHIVE_RECORDS = 20_000

#: Bytes read, inflated or written at once.
AT_ONCE = 1 << 20

#: A header is no longer than this.
HEADER_BYTES = 1 << 20

#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_DIGITS, BASE32_LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Copies of each first record's key where they are too many to broadcast, so that a hot payload is no single task's.
SALTS = 16

_FIELDS = ("record_id", "record_type", "target_uri", "payload_digest", "refers_to")
_HEADERS = (b"warc-record-id", b"warc-type", b"warc-target-uri", b"warc-payload-digest", b"warc-refers-to")
_INDEX_DDL = "archive string, offset long, length long, inflated long, " + ", ".join(f"{f} string" for f in _FIELDS)


class WarcFault(ValueError):
    """What is read is not a sound archive or record."""


# ---------------------------------------------------------------- writing


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a text's UTF-8 bytes in upper-case base32: 40 bits at a time, eight digits each."""
    digits = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), BASE32_DIGITS, BASE32_LETTERS)


def _one_line(url: Column) -> Column:
    """An address fit for a header line: control characters and spaces are escaped."""
    escaped = reduce(lambda u, n: F.replace(u, F.lit(chr(n)), F.lit(f"%{n:02X}")), [*range(33), 127], url)
    return F.when(url.rlike(r"[\x00-\x20\x7f]"), escaped).otherwise(url)


def with_revisits(pages: DataFrame, record: str, payload: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """pages with `__refers_to`: the smallest id among the rows of equal payload, null for that row itself.

    Payloads shorter than min_bytes have none. Only payload hashes are shuffled
    to find the firsts; the pages meet them by broadcast, or beyond its bound by
    a join on hash and salt.
    """
    key = F.sha2(F.coalesce(F.col(payload), F.lit("")).cast("binary"), 256)
    long_enough = F.octet_length(F.coalesce(F.col(payload), F.lit(""))) >= min_bytes
    found = pages.where(long_enough).groupBy(key.alias("__key")).agg(F.min(record).alias("__first"), F.count("*").alias("__n"))
    firsts = stored(found.where("__n > 1 AND __first IS NOT NULL").select("__key", "__first"), "firsts")
    keyed = pages.withColumn("__key", key)
    if firsts.count() <= scratch.BROADCAST_ROWS:
        joined = keyed.join(F.broadcast(firsts), "__key", "left")
    else:
        salted = keyed.withColumn("__salt", F.pmod(F.hash(record), F.lit(SALTS)))
        copies = firsts.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(copies, ["__key", "__salt"], "left").drop("__salt")
    other = ~F.col(record).eqNullSafe(F.col("__first"))
    return joined.withColumn("__refers_to", F.when(F.col("__first").isNotNull() & other, F.col("__first"))).drop("__key", "__first")


def record_text(record: Column, url: Column, payload: Column, refers_to: Column, date: str) -> Column:
    """A record without its last line end: header, HTTP header and, but for revisits, the payload."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    again = refers_to.isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"),
        line("Content-Length", F.octet_length(payload).cast("string")),
        F.lit("\r\n"),
    )
    block = F.octet_length(http) + F.when(again, F.lit(0)).otherwise(F.octet_length(payload))
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(record)),
        F.coalesce(line("WARC-Target-URI", _one_line(url)), F.lit("")),
        F.lit(f"WARC-Date: {date}\r\n"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(payload))),
        F.when(again, F.concat(line("WARC-Refers-To", urn(refers_to)), F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\n"))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", block.cast("string")),
    )
    return F.concat(header, F.lit("\r\n"), http, F.when(again, F.lit("")).otherwise(payload), F.lit("\r\n"))


def write_archives(pages: DataFrame, folder: str, date: str, min_bytes: int = MIN_BYTES, records: int = ARCHIVE_RECORDS) -> None:
    """Write a record per row of pages(page_id, url, html), each file one gzip stream.

    Null html is empty. Of equal payloads the row with the smallest page_id is a
    response, the others are revisits of it; rows that share this page_id are all
    responses. Rows without page_id have a record without number, and are
    responses where all of their payload's rows are. An empty table writes an
    empty archive or none.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = with_revisits(rows, "page_id", "html", min_bytes)
    text = record_text(F.col("page_id"), F.col("url"), F.col("html"), F.col("__refers_to"), date)
    sink = rows.select(text.alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", records)
    sink.option("lineSep", "\r\n").text(folder)


# ---------------------------------------------------------------- streams


class Inflated:
    """The bytes that a gzip stream of one or more members, or a plain file, holds; a bounded part at a time."""

    def __init__(self, raw: BinaryIO):
        self._raw, self._left, self._buffer, self._ended = raw, b"", bytearray(), False
        head = raw.read(max(2, AT_ONCE))
        self._inflater = zlib.decompressobj(31) if head[:2] == b"\x1f\x8b" else None
        self._left = head

    def _more(self) -> bool:
        """Read on; False at the end of the file."""
        if self._ended:
            return False
        data = self._left or self._raw.read(AT_ONCE)
        self._left = b""
        if not data:
            self._ended = True
            if self._inflater is not None and not self._inflater.eof:
                raise WarcFault("the compressed stream is cut off")
            return False
        if self._inflater is None:
            self._buffer += data
            return True
        if self._inflater.eof:
            if not data.strip(b"\0"):  # padding after the last member
                return True
            self._inflater = zlib.decompressobj(31)
        try:
            self._buffer += self._inflater.decompress(data, AT_ONCE)
        except zlib.error as e:
            raise WarcFault(f"the compressed stream is broken: {e}") from e
        self._left = self._inflater.unused_data if self._inflater.eof else self._inflater.unconsumed_tail
        return True

    def until(self, end: bytes, limit: int) -> bytes | None:
        """Bytes up to and with `end`; None if only blank lines are left."""
        at = 0
        while True:
            if at == 0:
                blank = len(self._buffer) - len(self._buffer.lstrip(b"\r\n"))
                del self._buffer[:blank]
            found = self._buffer.find(end, max(0, at - len(end)))
            if found >= 0:
                out = bytes(self._buffer[: found + len(end)])
                del self._buffer[: found + len(end)]
                return out
            at = len(self._buffer)
            if at > limit:
                raise WarcFault("there is no record")
            if not self._more():
                if at == 0:
                    return None
                raise WarcFault("the last header is cut off")

    def parts(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in parts."""
        while n:
            if not self._buffer and not self._more():
                raise WarcFault("the last record is cut off")
            part = bytes(self._buffer[:n])
            del self._buffer[: len(part)]
            n -= len(part)
            if part:
                yield part


def header_fields(head: bytes) -> dict[bytes, bytes]:
    """The named fields of a header, names in lower case."""
    first, *lines = head.split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise WarcFault("a record does not begin as one")
    fields, name = {}, b""
    for line in lines:
        if line[:1] in (b" ", b"\t") and name:  # a folded line
            fields[name] += b" " + line.strip()
        elif b":" in line:
            name, _, value = line.partition(b":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def block_length(fields: dict[bytes, bytes]) -> int:
    length = fields.get(b"content-length", b"")
    if not length.isdigit():
        raise WarcFault("a record has no length")
    return int(length)


def members(raw: BinaryIO, out: BinaryIO) -> Iterator[dict]:
    """Inflate a whole archive once and write every record as a gzip member; the index entry of each.

    A record is told when it has been written whole; a fault ends the stream
    after the last sound record, and `out` may hold a broken member behind it.
    """
    stream, offset = Inflated(raw), 0
    while (head := stream.until(b"\r\n\r\n", HEADER_BYTES)) is not None:
        fields = header_fields(head)
        size = block_length(fields)
        deflater = zlib.compressobj(6, zlib.DEFLATED, 31)
        length = out.write(deflater.compress(head))
        for part in stream.parts(size):
            length += out.write(deflater.compress(part))
        length += out.write(deflater.compress(b"\r\n\r\n") + deflater.flush())
        told = {f: fields[h].decode("utf-8", "replace") if h in fields else None for f, h in zip(_FIELDS, _HEADERS)}
        yield {"offset": offset, "length": length, "inflated": len(head) + size + 4, **told}
        offset += length


# ---------------------------------------------------------------- files


def _open(uri: str):
    """(file system, path) of an address as Spark writes it."""
    from pyarrow import fs

    place = re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):/(?!/)", r"\1:///", uri)
    if place.startswith("file://"):  # plain path, whatever characters it has
        return fs.LocalFileSystem(), place.removeprefix("file://")
    return fs.FileSystem.from_uri(place) if "://" in place else (fs.LocalFileSystem(), place)


def _normalise_file(source: str, target: str) -> tuple[str, int, int, str | None]:
    """Rewrite one archive: its new name, its records, its bytes and what was wrong with it, if anything."""
    own = hashlib.sha256(source.encode()).hexdigest()[:16]
    stem = re.sub(r"(\.txt|\.warc)?(\.gz)?$", "", source.rsplit("/", 1)[-1])
    name, mark, fault, entries = f"{stem}-{own}.warc.gz", uuid.uuid4().hex, None, []
    (from_fs, from_path), (to_fs, to_path) = _open(source), _open(target)
    to_fs.create_dir(to_path, recursive=True)
    draft, index = f"{to_path}/.{name}.{mark}", f"{to_path}/.{name}.index.{mark}"
    size = 0
    with from_fs.open_input_stream(from_path, compression=None) as raw, to_fs.open_output_stream(draft, compression=None) as out:
        with to_fs.open_output_stream(index, compression=None) as sidecar:
            n = 0
            try:
                for entry in members(raw, out):
                    sidecar.write(json.dumps({"archive": name, **entry}).encode() + b"\n")
                    n, size = n + 1, entry["offset"] + entry["length"]
            except WarcFault as e:
                fault = str(e)
    to_fs.move(draft, f"{to_path}/{name}")
    to_fs.move(index, f"{to_path}/{name}.index.jsonl")
    return name, n, size, fault


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every archive (*.gz, *.warc) below source; stored (archive, source, records, bytes, fault), a row for each.

    Of an archive that is cut off or broken the sound records before the fault
    are kept and indexed, and `fault` says what is wrong; it is null otherwise.
    A folder without archives gives no row.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                name, n, size, fault = _normalise_file(path, target)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([path]), pa.array([n]), pa.array([size]), pa.array([fault], pa.string())],
                    names=["archive", "source", "records", "bytes", "fault"],
                )

    ship_code(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{gz,warc}").load(source)
    made = files.select("path").mapInArrow(rewrite, "archive string, source string, records long, bytes long, fault string")
    return stored(made, "normalised")


# ---------------------------------------------------------------- reading


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecar entries of all archives of a folder: archive, offset, length, inflated and the header's fields."""
    return spark.read.schema(_INDEX_DDL).option("pathGlobFilter", "*.index.jsonl").json(folder)


def open_member(data: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """Fields and block of a record that is a gzip member of its own."""
    whole = zlib.decompress(data, 31)
    head, found, rest = whole.partition(b"\r\n\r\n")
    fields = header_fields(head)
    size = block_length(fields)
    if not found or len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcFault("a record has not the length that it tells")
    return fields, rest[:size]


def payload_of(fields: dict[bytes, bytes], block: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """HTTP fields and payload of a block; one without HTTP header is its payload."""
    if not fields.get(b"content-type", b"").startswith(b"application/http"):
        return {}, block
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = [line.partition(b":") for line in head.split(b"\r\n")[1:]]
    return {n.strip().lower(): v.strip() for n, _, v in lines}, payload


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that index rows name: record_id, record_type, target_uri, refers_to, payload_bytes, payload_digest, payload.

    Each record is read at its offset and inflated alone. The digest and length
    of a response are those of the payload that was read, which must agree with
    its header; those of a revisit, of the payload that it stands for, are its
    header's. Without `payloads` that column is null.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        name, file = None, None
        for batch in batches:
            out, held = [], 0
            for archive, offset, length in zip(*[batch.column(c).to_pylist() for c in ("archive", "offset", "length")]):
                if archive != name:
                    if file is not None:
                        file.close()
                    name, file = archive, store.open_input_file(f"{path}/{archive}")
                file.seek(offset)
                fields, block = open_member(file.read(length))
                http, payload = payload_of(fields, block)
                shown = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode()
                size = len(payload)
                if fields.get(b"warc-type") == b"revisit":
                    size = int(http.get(b"content-length", b"0"))
                else:
                    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if shown and own != shown:
                        raise WarcFault(f"{archive}, {offset}: the payload is not that of its digest")
                    shown = own
                texts = [fields[h].decode("utf-8", "replace") if h in fields else None for h in (_HEADERS[0], _HEADERS[1], _HEADERS[2], _HEADERS[4])]
                out.append((*texts, size, shown, payload if payloads else None))
                held += len(payload) if payloads else 0
                if held > 8 * AT_ONCE:
                    yield _batch(out)
                    out, held = [], 0
            if out:
                yield _batch(out)
        if file is not None:
            file.close()

    ship_code(index.sparkSession)
    return index.select("archive", "offset", "length").mapInArrow(told, _READ_DDL)


_READ = pa.schema(
    [(c, pa.string()) for c in ("record_id", "record_type", "target_uri", "refers_to")]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)
_READ_DDL = "record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _READ)], schema=_READ)


def page_number(urn: Column) -> Column:
    """The page_id that a record id names; null for a record without number."""
    return F.nullif(F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1), F.lit("")).cast("long")


def warc_report(pages: DataFrame, folder: str | None = None, date: str = "2025-12-02T06:00:00Z", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write pages, normalise the archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    One row per page, repeated rows too; null and empty html have the payload of
    no bytes; an empty table gives an empty one; extra columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    write_archives(pages, f"{folder}/monolithic", date, min_bytes)
    faults = normalise(spark, f"{folder}/monolithic", f"{folder}/records").where("fault is not null").first()
    if faults:
        raise WarcFault(f"{faults['source']}: {faults['fault']}")
    read = read_records(read_index(spark, f"{folder}/records"), f"{folder}/records", payloads=False)
    return read.select(
        page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_number(F.col("refers_to")).alias("refers_to"),
    )
