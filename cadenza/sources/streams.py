"""Streams of media files from their headers: which there are, and their rates and durations.

WAV, FLAC and MP4 files are walked by the sizes in their headers. Only headers are read, a few kilobytes a file whatever its length, in many tasks;
samples, frames and the tables of a long film are passed over.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cadenza.sources.files import listed, store

STREAMS = "path string, stream_index int, kind string, codec string, sample_rate int, channels int, duration double, bytes_read long, problem string"
FILES_A_TASK, MOST_BOXES = 256, 4096


class Ranges:
    """Reads of an open file, counted."""

    def __init__(self, file) -> None:
        self.file, self.size, self.read = file, file.size(), 0

    def at(self, place: int, n: int) -> bytes:
        """n bytes from a place; ValueError where the file is shorter."""
        self.file.seek(place)
        data = self.file.read(n)
        self.read += len(data)
        if len(data) < n:
            raise ValueError("the file ends within a header")
        return data


def wav_streams(f: Ranges) -> list[dict]:
    at, rate, channels, step, bits, tag, wide = 12, 0, 0, 0, 0, 0, None
    while at + 8 <= f.size:
        kind, n = struct.unpack("<4sI", f.at(at, 8))
        if kind == b"fmt ":
            tag, channels, rate, _, step, bits = struct.unpack("<HHIIHH", f.at(at + 8, 16))
            if tag == 0xFFFE and n >= 26:
                tag = struct.unpack("<H", f.at(at + 32, 2))[0]
        elif kind == b"ds64":
            wide = struct.unpack("<Q", f.at(at + 16, 8))[0]
        elif kind == b"data":
            left = f.size - at - 8
            n = wide if n == 0xFFFFFFFF and wide is not None else n
            n = left if n == 0xFFFFFFFF else min(n, left)
            if not step or not rate:
                raise ValueError("audio with no channels or no sample rate")
            codec = {1: "pcm_u8" if bits == 8 else f"pcm_s{bits}le", 3: f"pcm_f{bits}le"}.get(tag, f"wav_{tag}")
            return [{"kind": "audio", "codec": codec, "sample_rate": rate, "channels": channels, "duration": n // step / rate}]
        at += 8 + n + n % 2
    raise ValueError("a WAV file without samples")


def flac_streams(f: Ranges) -> list[dict]:
    head = f.at(4, 4)
    if head[0] & 0x7F or int.from_bytes(head[1:], "big") < 34:
        raise ValueError("a FLAC file without stream information")
    about = int.from_bytes(f.at(18, 8), "big")  # rate 20 bits, channels 3, depth 5, samples 36
    rate, samples = about >> 44, about & (1 << 36) - 1
    if not rate:
        raise ValueError("audio with no sample rate")
    return [{"kind": "audio", "codec": "flac", "sample_rate": rate, "channels": (about >> 41 & 7) + 1, "duration": samples / rate if samples else None}]


def boxes(f: Ranges, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(type, first byte of the content, end) of the boxes between two places."""
    for _ in range(MOST_BOXES):
        if at + 8 > end:
            return
        n, kind = struct.unpack(">I4s", f.at(at, 8))
        body = at + 8
        if n == 1:
            n, body = struct.unpack(">Q", f.at(body, 8))[0], at + 16
        stop = end if n == 0 else at + n
        if stop < body or stop > end:
            raise ValueError(f"a box {kind!r} that is larger than what it lies in")
        yield kind, body, stop
        at = stop
    raise ValueError("too many boxes")


def _within(f: Ranges, at: int, end: int, *path: bytes) -> tuple[int, int] | None:
    """The content of the first box at a path of types."""
    for kind, a, b in boxes(f, at, end):
        if kind == path[0]:
            return (a, b) if len(path) == 1 else _within(f, a, b, *path[1:])
    return None


def _scaled(f: Ranges, at: int) -> tuple[int, int]:
    """(units a second, duration in units, 0 if unknown) of an mdhd or mvhd box."""
    if f.at(at, 1)[0] == 1:
        scale, n = struct.unpack(">IQ", f.at(at + 20, 12))
        return scale, 0 if n == 2**64 - 1 else n
    scale, n = struct.unpack(">II", f.at(at + 12, 8))
    return scale, 0 if n == 2**32 - 1 else n


def mp4_streams(f: Ranges) -> list[dict]:
    movie = _within(f, 0, f.size, b"moov")
    if movie is None:
        raise ValueError("an MP4 file without a movie box")
    whole = None  # of a fragmented file, whose tracks are of length 0 here
    if (more := _within(f, *movie, b"mvex", b"mehd")) and (head := _within(f, *movie, b"mvhd")):
        long = f.at(more[0], 1)[0] == 1
        n = struct.unpack(">Q" if long else ">I", f.at(more[0] + 4, 8 if long else 4))[0]
        whole = n / scale if (scale := _scaled(f, head[0])[0]) else None
    out = []
    for kind, a, b in boxes(f, *movie):
        if kind != b"trak":
            continue
        media = _within(f, a, b, b"mdia")
        if media is None:
            raise ValueError("a track without media")
        head, handler = _within(f, *media, b"mdhd"), _within(f, *media, b"hdlr")
        name = f.at(handler[0] + 8, 4) if handler else b""
        row = {"kind": {b"soun": "audio", b"vide": "video"}.get(name, "other"), "codec": None, "sample_rate": None, "channels": None, "duration": None}
        if head:
            scale, n = _scaled(f, head[0])
            row["duration"] = n / scale if scale and n else whole
        table = _within(f, *media, b"minf", b"stbl", b"stsd")
        if table and table[1] - table[0] >= 16:
            row["codec"] = f.at(table[0] + 12, 4).decode("latin1").strip()
            if row["kind"] == "audio" and table[1] - table[0] >= 44:
                row["channels"], _, _, rate = struct.unpack(">HHII", f.at(table[0] + 32, 12))
                row["sample_rate"] = (rate >> 16) or (scale if head else None)
        out.append(row)
    return out


def streams_in(f: Ranges) -> list[dict]:
    """The streams of a file of a known kind, in order."""
    start = f.at(0, 12)
    if start[:4] in (b"RIFF", b"RF64", b"BW64") and start[8:] == b"WAVE":
        return wav_streams(f)
    if start[:4] == b"fLaC":
        return flac_streams(f)
    if start[4:8] in (b"ftyp", b"moov", b"mdat", b"free", b"skip", b"wide"):
        return mp4_streams(f)
    raise ValueError("no WAV, FLAC or MP4 file")


@dataclass
class _Files(InputPartition):
    paths: list[str]


class _Reader(DataSourceReader):
    def __init__(self, path: str, pattern: str) -> None:
        self.path, self.pattern = path, pattern

    def partitions(self) -> list[InputPartition]:
        paths = [p for p, _ in listed(self.path, self.pattern)]
        return [_Files(paths[k : k + FILES_A_TASK]) for k in range(0, len(paths), FILES_A_TASK)]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
        schema = pa.schema([(n, kinds[t]) for n, t in (f.split() for f in STREAMS.split(", "))])
        for path in partition.paths if partition else []:
            system, at = store(path)
            with system.open_input_file(at) as file:
                f = Ranges(file)
                try:
                    found = [{"stream_index": k, **s} for k, s in enumerate(streams_in(f))] or [{}]
                except ValueError as e:
                    found = [{"problem": str(e)}]
                yield pa.RecordBatch.from_pylist([{"path": path, "bytes_read": f.read, **s} for s in found], schema)


class MediaStreams(DataSource):
    """``spark.read.format("media_streams")``. Options: path, pattern."""

    @classmethod
    def name(cls) -> str:
        return "media_streams"

    def schema(self) -> str:
        return STREAMS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("pattern", "*"))


def media_streams(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The streams of the files at or below a path. A file without streams, or that can't be read (``problem``), is a row without stream_index."""
    spark.dataSource.register(MediaStreams)
    return spark.read.format("media_streams").option("pattern", pattern).load(path)


def audio_streams(streams: DataFrame) -> DataFrame:
    """path, stream_index (among the file's audio streams), duration (text) for the size estimates and manifests of ``operators.media``."""
    own = streams.where("kind = 'audio'").groupBy("path").agg(F.array_sort(F.collect_list(F.struct("stream_index", "duration"))).alias("_s"))
    return own.select("path", F.posexplode("_s").alias("stream_index", "_d")).select("path", "stream_index", F.col("_d.duration").cast("string").alias("duration"))


def audio_counts(streams: DataFrame) -> DataFrame:
    """path, streams: audio streams of every file, 0 where it has none."""
    return streams.groupBy("path").agg(F.count_if(F.col("kind") == "audio").alias("streams"))
