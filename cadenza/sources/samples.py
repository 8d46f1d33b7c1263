"""Data sources over parts of files: PCM WAV (RIFF and RF64) and NPY signals of any length as blocks of samples.

A file over ``split_bytes`` is read by many tasks, each taking whole blocks (a multiple of a frame, so that no frame crosses
a block) by reading their bytes only; small files are read many to a task. Planning lists names and sizes and opens no file. A task holds one
block at a time.

Filters on path, channel and block_start are pushed down: blocks that they rule out are not read at all. A Python source isn't told
which columns are wanted; ``samples=False`` gives the blocks' places without reading their bytes.
"""

from __future__ import annotations

import ast
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from cadenza.operators.audio import frame_length
from cadenza.sources.files import listed, store

BLOCKS = "path string, channel int, block_start long, sample_rate int, bits int, samples array<double>"
FRAMES_A_BLOCK, SPLIT_BYTES = 400, 64 << 20


def audio_source(spark: SparkSession, path: str, scale: str = "full", samples: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Blocks of each channel of the WAV files at or below ``path``. ``scale``: "full" over 2**31 - 1, "bit_depth" over 2**(bits - 1)."""
    if scale not in ("full", "bit_depth"):
        raise ValueError(f"no such scale: {scale}")
    return _load(spark, path, kind="wav", scale=scale, samples=samples, split_bytes=split_bytes)


def npy_source(spark: SparkSession, path: str, sample_rate: int = 16000, samples: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Blocks of the NPY files at or below ``path``; a 2-D array has a channel a row and is averaged to mono."""
    frame_length(sample_rate)
    return _load(spark, path, kind="npy", sample_rate=sample_rate, samples=samples, split_bytes=split_bytes)


def _load(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(SampleBlocks)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("sample_blocks").options(**options).load(path)


class Wav:
    """The format of an open WAV file, and parts of its samples."""

    def __init__(self, file, scale: str) -> None:
        self.file, size = file, file.size()
        head = self._at(0, 12)
        if len(head) < 12 or head[:4] not in (b"RIFF", b"RF64", b"BW64") or head[8:] != b"WAVE":
            raise ValueError("no WAV file")
        at, wide, form = 12, None, None
        while True:
            chunk = self._at(at, 8)
            if len(chunk) < 8:
                raise ValueError("a WAV file without samples")
            kind, n = chunk[:4], struct.unpack("<I", chunk[4:])[0]
            if kind == b"ds64":
                wide = struct.unpack("<Q", self._at(at + 16, 8))[0]
            elif kind == b"fmt ":
                form = self._at(at + 8, min(n, 40))
            elif kind == b"data":
                break
            at += 8 + n + n % 2
        if form is None or len(form) < 16:
            raise ValueError("a WAV file without a format")
        tag, self.channels, self.rate, _, _, self.bits = struct.unpack("<HHIIHH", form[:16])
        if tag == 0xFFFE and len(form) >= 26:
            tag = struct.unpack("<H", form[24:26])[0]
        if tag != 1 or self.bits not in (8, 16, 24, 32):
            raise ValueError("samples that are no integers of 8, 16, 24 or 32 bits")
        if not self.channels or not self.rate:
            raise ValueError("audio with no channels or no sample rate")
        n = wide if n == 0xFFFFFFFF and wide is not None else n
        self.start, self.step = at + 8, self.channels * self.bits // 8
        self.length = (size - self.start if n == 0xFFFFFFFF else min(n, size - self.start)) // self.step
        self.scale = 2147483647.0 if scale == "full" else float(2 ** (self.bits - 1))

    def _at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def part(self, a: int, b: int) -> np.ndarray:
        """Samples a to b of all channels [b - a, channels]."""
        raw = np.frombuffer(self._at(self.start + a * self.step, (b - a) * self.step), np.uint8)
        if self.bits == 8:
            x = raw.astype(np.int64) - 128
        elif self.bits == 24:
            x = np.zeros((len(raw) // 3, 4), np.uint8)
            x[:, 1:] = raw.reshape(-1, 3)
            x = x.view("<i4").ravel() >> 8
        else:
            x = raw.view(f"<i{self.bits // 8}")
        return (x / self.scale).reshape(-1, self.channels)


class Npy:
    """The same of an NPY file: one channel, the mean of the rows of a 2-D array."""

    channels, bits = 1, 32

    def __init__(self, file, rate: int) -> None:
        self.file, self.rate = file, rate
        file.seek(0)
        head = file.read(12)
        if head[:6] != b"\x93NUMPY":
            raise ValueError("no NPY file")
        begin, n = (10, struct.unpack("<H", head[8:10])[0]) if head[6] == 1 else (12, struct.unpack("<I", head[8:12])[0])
        file.seek(begin)
        about = ast.literal_eval(file.read(n).decode("latin1"))
        self.dtype, self.across = np.dtype(about["descr"]), about["fortran_order"]
        if self.dtype.hasobject or len(about["shape"]) not in (1, 2):
            raise ValueError("no array of one or two dimensions of numbers")
        self.rows, self.length = (1, *about["shape"])[-2:]
        self.start = begin + n

    def _read(self, at: int, n: int) -> np.ndarray:
        self.file.seek(self.start + at * self.dtype.itemsize)
        return np.frombuffer(self.file.read(n * self.dtype.itemsize), self.dtype).astype(float)

    def part(self, a: int, b: int) -> np.ndarray:
        if self.across and self.rows > 1:
            x = self._read(a * self.rows, (b - a) * self.rows).reshape(-1, self.rows).mean(axis=1)
        elif self.rows:
            x = np.stack([self._read(r * self.length + a, b - a) for r in range(self.rows)]).mean(axis=0)
        else:
            x = np.full(b - a, np.nan)
        return x.reshape(-1, 1)


@dataclass
class _Parts(InputPartition):
    """(path, k, of): the k-th of so many parts of each file."""

    files: list[tuple[str, int, int]]


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path, self.kind, self.scale = options["path"], options.get("kind", "wav"), options.get("scale", "full")
        self.rate, self.split = int(options.get("sample_rate", 16000)), max(1, int(options.get("split_bytes", SPLIT_BYTES)))
        self.samples = str(options.get("samples", "true")).lower() == "true"
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, IsNotNull) and f.attribute != ("samples",):
                continue  # none of these is ever null
            fits = isinstance(f, (EqualTo, In)) and f.attribute in (("path",), ("channel",), ("block_start",))
            if fits or isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute in (("channel",), ("block_start",)):
                self.filters.append(f)
            else:
                yield f

    def _passes(self, column: str, value) -> bool:
        for f in self.filters:
            if f.attribute == (column,):
                ok = (
                    value in f.value if isinstance(f, In)
                    else value == f.value if isinstance(f, EqualTo)
                    else value > f.value if isinstance(f, GreaterThan)
                    else value >= f.value if isinstance(f, GreaterThanOrEqual)
                    else value < f.value if isinstance(f, LessThan)
                    else value <= f.value
                )
                if not ok:
                    return False
        return True

    def partitions(self) -> list[InputPartition]:
        out, small, held = [], [], 0
        for path, size in listed(self.path, f"*.{self.kind}"):
            if not self._passes("path", path):
                continue
            of = -(-size // self.split)
            if of > 1:
                out += [_Parts([(path, k, of)]) for k in range(of)]
            else:
                small.append((path, 0, 1))
                held += size
                if held >= self.split:
                    out.append(_Parts(small))
                    small, held = [], 0
        return [*out, _Parts(small)] if small else out

    def read(self, partition: _Parts) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("channel", pa.int32()), ("block_start", pa.int64()), ("sample_rate", pa.int32()), ("bits", pa.int32()), ("samples", pa.list_(pa.float64()))])
        for path, k, of in partition.files if partition else []:
            system, at = store(path)
            with system.open_input_file(at) as file:
                try:
                    signal = Wav(file, self.scale) if self.kind == "wav" else Npy(file, self.rate)
                except ValueError as e:
                    raise ValueError(f"{path}: {e}") from e
                size = frame_length(signal.rate) * FRAMES_A_BLOCK
                blocks = -(-signal.length // size)
                wanted = [c for c in range(signal.channels) if self._passes("channel", c)]
                for block in range(blocks * k // of, blocks * (k + 1) // of):
                    a, b = block * size, min(signal.length, (block + 1) * size)
                    if not wanted or not self._passes("block_start", a):
                        continue
                    x = signal.part(a, b) if self.samples else None
                    for c in wanted:
                        values = pa.nulls(1, pa.list_(pa.float64())) if x is None else pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pa.array(np.ascontiguousarray(x[:, c])))
                        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([c], pa.int32()), pa.array([a], pa.int64()), pa.array([signal.rate], pa.int32()), pa.array([signal.bits], pa.int32()), values], schema=schema)


class SampleBlocks(DataSource):
    """``spark.read.format("sample_blocks")``. Options: path, kind (wav, npy), scale, sample_rate, samples, split_bytes."""

    @classmethod
    def name(cls) -> str:
        return "sample_blocks"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
