"""Readers: WAV, FLAC (a caller's decoder), NPY, video frames (a caller's decoder), CSV and transcripts.

Bytes come from Spark's binaryFile reader, so that any store that Spark reads will do; decoding runs in
mapInPandas, a file a row, and gives blocks whose size is a multiple of a frame, so that later steps shuffle
nothing to find frames.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.images import resize
from cadenza.operators.audio import frame_length

BLOCKS = "path string, channel int, block_start long, sample_rate int, bits int, samples array<double>"
FRAMES = "path string, frame_idx long, h int, w int, pixels binary"
#: Frames in a block of samples, and rows in a batch that a reader gives to Spark.
FRAMES_A_BLOCK, ROWS = 400, 64


def batched(rows: Iterator[tuple], schema: str) -> Iterator[pd.DataFrame]:
    """Rows in frames of ROWS."""
    columns = [f.split()[0] for f in schema.split(", ")]
    while part := list(islice(rows, ROWS)):
        yield pd.DataFrame(part, columns=columns)


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "content")


def decode_wav(data: bytes) -> tuple[np.ndarray, int, int]:
    """(integers [samples, channels], sample rate, bits) of a PCM WAV file."""
    with wave.open(io.BytesIO(data)) as w:
        channels, width, rate, raw = w.getnchannels(), w.getsampwidth(), w.getframerate(), w.readframes(w.getnframes())
    if not channels or not rate:
        raise ValueError("audio with no channels or no sample rate")
    if width == 1:
        x = np.frombuffer(raw, np.uint8).astype(np.int64) - 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int64)
        x = b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16
        x = np.where(x >= 1 << 23, x - (1 << 24), x)
    else:
        x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.int64)
    return x.reshape(-1, channels), rate, 8 * width


def audio_blocks(content: DataFrame, decoder: Callable[[bytes], tuple] = decode_wav, scale: str = "full") -> DataFrame:
    """Blocks of each channel of files (path, content). ``scale``: "full" over 2**31 - 1, "bit_depth" over 2**(bits - 1)."""
    if scale not in ("full", "bit_depth"):
        raise ValueError(f"no such scale: {scale}")

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for pdf in frames:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                x, rate, bits = decoder(bytes(data))
                x = x / (2147483647.0 if scale == "full" else float(2 ** (bits - 1)))
                size = frame_length(rate) * FRAMES_A_BLOCK
                for at in range(0, len(x), size):
                    yield from ((path, c, at, rate, bits, x[at : at + size, c]) for c in range(x.shape[1]))

    return content.mapInPandas(lambda frames: batched(rows(frames), BLOCKS), BLOCKS)


def npy_blocks(content: DataFrame, sample_rate: int = 16000) -> DataFrame:
    """Blocks of NPY files; a 2-D array has a channel a row and is averaged to mono."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        size = frame_length(sample_rate) * FRAMES_A_BLOCK
        for pdf in frames:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                x = np.load(io.BytesIO(bytes(data)), allow_pickle=False).astype(float)
                x = x.mean(axis=0) if x.ndim == 2 else x
                yield from ((path, 0, at, sample_rate, 32, x[at : at + size]) for at in range(0, len(x), size))

    return content.mapInPandas(lambda frames: batched(rows(frames), BLOCKS), BLOCKS)


def video_frames(content: DataFrame, decoder: Callable[[bytes], Iterator[np.ndarray]], width: int = 224, height: int = 224) -> DataFrame:
    """Gray frames of files as bytes, resized bilinearly; the decoder gives RGB arrays [h, w, 3] in order."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for pdf in frames:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                for k, image in enumerate(decoder(bytes(data))):
                    small = np.rint(resize(np.asarray(image)[None].astype(float), height, width)[0])
                    gray = np.rint(small @ [0.299, 0.587, 0.114]).astype(np.uint8)
                    yield path, k, height, width, gray.tobytes()

    return content.mapInPandas(lambda frames: batched(rows(frames), FRAMES), FRAMES)


def feature_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV with a header, typed by ``schema`` or by what is in it."""
    reader = spark.read.option("header", True).option("escape", '"')
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def emotion_csv(spark: SparkSession, path: str) -> DataFrame:
    """Emotion scores with the probabilities' text as an array."""
    rows = feature_csv(spark, path, "chunk_index long, start_sec double, end_sec double, predicted_emotion string, emotion_probs string")
    return rows.withColumn("emotion_probs", F.from_json("emotion_probs", "array<double>"))


def transcript_json(spark: SparkSession, path: str) -> DataFrame:
    """path, segments of transcript files, a JSON object each."""
    from cadenza.operators.transcript import SEGMENTS

    return spark.read.schema(f"segments {SEGMENTS}").option("multiLine", True).json(path).select(F.input_file_name().alias("path"), "segments")


def clean_pitch(rows: DataFrame) -> DataFrame:
    """A pitch table with numbers for texts: "no data" and empty cells become null."""
    return rows.select(*(F.when(F.col(c) != "no data", F.col(c)).try_cast("double").alias(c) if c.endswith("_pitch_hz") else F.col(c) for c in rows.columns))
