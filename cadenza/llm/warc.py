"""WARC 1.1 archives, Zstandard-compressed a record a frame, with the dictionary in the leading skippable frame.

``write_pages`` makes records of pages: pages with equal payloads are one response and revisits of it. Each task
writes its archives below ``_temporary`` under names of its own; at the end of the job the archives of the attempts that
succeeded are moved into place, so that retries and lost executors leave no record twice. Each
archive has a dictionary trained on its own first records, and is closed at a bound of bytes.

``read_records`` reads archives of any writer, one archive a task, a frame at a time: it loads the dictionary, decodes one frame a
record, and checks version, required headers, Content-Length, the end of the record, and block and payload digests. What fails a
check ends the job, or with ``keep_bad`` is a row that says in ``problem`` what is wrong.

Cases: a null html is an empty payload; a null or odd url is left out or percent-encoded; a null page_id is smaller than all others,
and reads back as null. Rows of equal page_id and payload are all responses if that id is the largest of its payload, else all
revisits. Without pages there is one archive without records, or none, and no rows come back. Columns other than page_id, url and html are not
looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from cadenza.llm.scratch import materialize, release
from cadenza.sources.files import listed, store

#: Fixed values of the formats: magic numbers of frames, and the profile of a revisit.
DICTIONARY_MAGIC, SKIPPABLE, FRAME_MAGIC = 0x184D2A5D, range(0x184D2A50, 0x184D2A60), 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

#: An archive is closed at so many bytes. Its dictionary is of DICTIONARY bytes, trained on records of SAMPLE_BYTES in all, cut to RECORD_BYTES each.
ARCHIVE_BYTES, DICTIONARY, SAMPLE_BYTES, RECORD_BYTES, LEVEL = 64 << 20, 32 << 10, 2 << 20, 64 << 10, 3
#: Bytes read at a time, and bytes of records in a batch that goes to Spark.
CHUNK, BATCH_BYTES = 1 << 18, 4 << 20
#: Groups of equal payloads that are broadcast (28 bytes each); more are joined in a shuffle, salted.
MOST_GROUPS, SALTS = 200_000, 16

_IN = "page_id long, target_uri string, payload binary, payload_digest string, record_type string, refers_to long"
RECORDS = (
    "archive string, number long, record_type string, record_id string, date string, target_uri string, refers_to string, content_type string, "
    "content_length long, payload_length long, payload_digest string, payload binary, problem string"
)


# --- writing -----------------------------------------------------------------------------------------------------


def _encoded(url: str) -> str:
    """What a header line can't hold (white space, control characters) as percent signs and numbers."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _urn(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, date: str) -> bytes:
    """A record with its headers, block and end. The block of a revisit is the HTTP header alone, which names the length of the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if kind == "response":
        block += payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_encoded(url)}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def trained(sample: list[bytes]) -> bytes:
    """A dictionary of these records; empty where they are too few or too short to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY, [s[:RECORD_BYTES] for s in sample], k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


class Archive:
    """One archive under way: the first records are held back until the dictionary is made."""

    def __init__(self, out, sample: int = SAMPLE_BYTES) -> None:
        self.out, self.sample, self.held, self.size, self.context = out, sample, [], 0, None

    def add(self, record: bytes) -> None:
        if self.context is None:
            self.held.append(record)
            self.size += len(record)
            if self.size >= self.sample:
                self._begin()
        else:
            self._frame(record)

    def _begin(self) -> None:
        data = trained(self.held)
        self.context = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data) if data else None, write_checksum=True)
        self.size = 0
        if data:
            packed = zstandard.ZstdCompressor(level=LEVEL).compress(data)
            self._put(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        for record in self.held:
            self._frame(record)
        self.held = []

    def _frame(self, record: bytes) -> None:
        self._put(self.context.compress(record))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        if self.context is None:
            self._begin()
        self.out.close()


@dataclass
class _Archives(WriterCommitMessage):
    names: list[str] = field(default_factory=list)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, date: str, most: int) -> None:
        self.path, self.date, self.most, self.job = path.rstrip("/"), date, most, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, at = store(self.path)
        system.create_dir(f"{at}/_temporary/{self.job}", recursive=True)
        names, archive = [], None
        for batch in iterator:
            columns = [batch.column(c) for c in ("page_id", "target_uri", "payload", "payload_digest", "record_type", "refers_to")]
            for k in range(len(batch)):
                if archive is None:
                    names.append(f"{uuid.uuid4().hex}.warc.zst")
                    archive = Archive(system.open_output_stream(f"{at}/_temporary/{self.job}/{names[-1]}", compression=None), min(SAMPLE_BYTES, self.most))
                archive.add(record_bytes(*(c[k].as_py() for c in columns), self.date))
                if archive.context is not None and archive.size >= self.most:
                    archive.close()
                    archive = None
        if archive is not None:
            archive.close()
        return _Archives(names)

    def commit(self, messages) -> None:
        system, at = store(self.path)
        system.create_dir(at, recursive=True)
        for message in messages:
            for name in message.names if message else []:
                system.move(f"{at}/_temporary/{self.job}/{name}", f"{at}/{name}")
        self._clear(system, at)

    def abort(self, messages) -> None:
        self._clear(*store(self.path))

    def _clear(self, system, at: str) -> None:
        if system.get_file_info(f"{at}/_temporary/{self.job}").type.name != "NotFound":
            system.delete_dir(f"{at}/_temporary/{self.job}")


# --- reading -----------------------------------------------------------------------------------------------------


def frames(source) -> Iterator[bytes]:
    """The content of each frame of an archive, read CHUNK bytes at a time; skippable frames are passed over, but for the dictionary in the first."""
    held, first, context = b"", True, zstandard.ZstdDecompressor()

    def upto(n: int) -> bytes:
        nonlocal held
        while len(held) < n:
            more = source.read(max(CHUNK, n - len(held)))
            if not more:
                break
            held += more
        return held[:n]

    while upto(1):
        head = upto(8)
        if len(head) < 8:
            raise ValueError("the archive ends within a frame")
        magic, size = struct.unpack("<II", head)
        if magic in SKIPPABLE:
            data = upto(8 + size)[8:]
            if len(data) < size:
                raise ValueError("the archive ends within a frame")
            held = held[8 + size :]
            if first and magic == DICTIONARY_MAGIC:
                if data[:4] == struct.pack("<I", FRAME_MAGIC):
                    data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
                context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
            first = False
            continue
        first = False
        if magic != FRAME_MAGIC:
            raise ValueError("no Zstandard frame where one should begin")
        one, parts = context.decompressobj(), []
        while not one.eof:
            if not upto(1):
                raise ValueError("the archive ends within a frame")
            part, held = held, b""
            parts.append(one.decompress(part))
        held = one.unused_data
        yield b"".join(parts)


def parsed(record: bytes) -> dict:
    """The columns of one record; ValueError says what is wrong with it."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC header")
    headers: dict[str, str] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:
            headers[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        name = name.lower()
        if not colon or not name or name != name.strip():
            raise ValueError(f"no header line: {line[:80]!r}")
        if name in headers and name != "warc-concurrent-to":
            raise ValueError(f"{name} stands twice")
        headers[name] = value.strip()
    missing = [h for h in REQUIRED if h.lower() not in headers]
    if missing:
        raise ValueError(f"no {missing[0]}")
    length = headers["content-length"]
    if not re.fullmatch("[0-9]+", length):
        raise ValueError("Content-Length is no number")
    block, end = rest[: int(length)], rest[int(length) :]
    if len(block) < int(length):
        raise ValueError(f"Content-Length is {length}, the block has {len(block)} bytes")
    if end != b"\r\n\r\n":
        raise ValueError("the record doesn't end where Content-Length says")
    if "warc-block-digest" in headers and _differs(headers["warc-block-digest"], block):
        raise ValueError("the block has another digest")
    kind, payload, size = headers["warc-type"], block, len(block)
    if headers.get("content-type", "").startswith("application/http"):
        http, mark, payload = block.partition(b"\r\n\r\n")
        if not mark:
            raise ValueError("no end of the HTTP header")
        told = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", http)
        size = int(told[1]) if told and kind == "revisit" else len(payload)
        if told and kind == "response" and int(told[1]) != len(payload):
            raise ValueError(f"the HTTP header says {int(told[1])} bytes, the payload has {len(payload)}")
    digest = headers.get("warc-payload-digest")
    if digest is not None and kind != "revisit" and _differs(digest, payload):
        raise ValueError("the payload has another digest")
    strip = lambda u: u[1:-1] if u is not None and u.startswith("<") and u.endswith(">") else u
    return {
        "record_type": kind, "record_id": strip(headers["warc-record-id"]), "date": headers["warc-date"], "target_uri": strip(headers.get("warc-target-uri")), "refers_to": strip(headers.get("warc-refers-to")),
        "content_type": headers.get("content-type"), "content_length": int(length), "payload_length": size, "payload_digest": digest.partition(":")[2] if digest else None, "payload": None if kind == "revisit" else payload, "problem": None,
    }


def _differs(label: str, data: bytes) -> bool:
    """Whether a SHA-1 label names other data; labels of other algorithms are not judged."""
    algorithm, _, value = label.partition(":")
    return algorithm.lower() == "sha1" and value.upper() not in (sha1(data), hashlib.sha1(data).hexdigest().upper())


@dataclass
class _File(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, path: str, keep_bad: bool, payloads: bool) -> None:
        self.path, self.keep_bad, self.payloads = path, keep_bad, payloads

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p, _ in listed(self.path, "*.warc.zst")]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no archive at all
            return
        names = [f.split()[0] for f in RECORDS.split(", ")]
        kinds = {"number": pa.int64(), "content_length": pa.int64(), "payload_length": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
        system, at = store(partition.path)
        rows, size = [], 0
        with system.open_input_stream(at, compression=None) as source:
            for number, record in enumerate(frames(source)):
                try:
                    row = parsed(record)
                except ValueError as e:
                    if not self.keep_bad:
                        raise ValueError(f"record {number} of {partition.path}: {e}") from e
                    row = {"problem": str(e)}
                rows.append({"archive": partition.path, "number": number, **row, "payload": row.get("payload") if self.payloads else None})
                size += len(record)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcZst(DataSource):
    """``spark.read.format("warc_zst")`` and ``df.write.format("warc_zst")``. Options: path, keep_bad, payloads, date, archive_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc_zst"

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema) -> DataSourceReader:
        flag = lambda name, default: str(self.options.get(name, default)).lower() == "true"
        return _Reader(self.options["path"], flag("keep_bad", "false"), flag("payloads", "true"))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("archives are only added")
        return _Writer(self.options["path"], self.options.get("date", "1970-01-01T00:00:00Z"), int(self.options.get("archive_bytes", ARCHIVE_BYTES)))


# --- pages ---------------------------------------------------------------------------------------------------------


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of bytes in upper-case base32: five hexadecimal digits are four characters."""
    code = F.sha1(data)
    parts = []
    for k in range(8):
        bits = F.conv(F.substring(code, 5 * k + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, target_uri, payload, payload_digest, record_type, refers_to of pages (page_id, url, html)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload")))
    alike = rows.where(F.octet_length("payload") >= least).groupBy("payload_digest").agg(F.max("page_id").alias("_last"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    groups = materialize(alike.withColumnRenamed("payload_digest", "_digest"), "equal-payloads")
    if groups.count() <= MOST_GROUPS:
        joined = rows.join(F.broadcast(groups), F.col("payload_digest") == F.col("_digest"), "left")
    else:
        spread = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = rows.withColumn("_own", F.pmod(F.xxhash64("page_id", "target_uri"), F.lit(SALTS)))
        joined = salted.join(spread, (F.col("payload_digest") == F.col("_digest")) & (F.col("_own") == F.col("_salt")), "left")
    again = F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    kind, target = F.when(again, "revisit").otherwise("response"), F.when(again, F.col("_last"))
    return joined.select("page_id", "target_uri", "payload", "payload_digest", kind.alias("record_type"), target.alias("refers_to"))


def write_pages(pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives (of ``archive_bytes`` and one record more at most) of all pages below ``path``; of pages with equal payloads of at least ``least`` bytes the one with the largest page_id is the response."""
    pages.sparkSession.dataSource.register(WarcZst)
    with_revisits(pages, least).write.format("warc_zst").option("date", date).option("archive_bytes", archive_bytes).mode("append").save(path)


def read_records(spark: SparkSession, path: str, keep_bad: bool = False, payloads: bool = True) -> DataFrame:
    """The records of the archives at or below ``path`` (RECORDS); without ``payloads`` these are checked but not passed on."""
    spark.dataSource.register(WarcZst)
    return spark.read.format("warc_zst").option("keep_bad", str(keep_bad)).option("payloads", str(payloads)).load(path)


def page_of(urn: Column) -> Column:
    """The page_id in the id of a record that ``write_pages`` made; null for others."""
    return F.regexp_extract(urn, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")
