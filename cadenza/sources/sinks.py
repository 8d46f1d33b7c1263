"""Writers: feature tables as CSV in the public column orders and number formats, and NPY exports.

Each table is one file in order, written by many tasks (``ordered.py``); with ``parts`` it is a folder of numbered files.
"""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import fixed
from cadenza.operators.audio import wide
from cadenza.operators.saliency import ORDER, SMOOTHED
from cadenza.sources.ordered import write_ordered

PLACES = {"rms": 6, "energy": 6, "pitch_hz": 2, "spectral_centroid": 2, "spectral_rolloff": 2, "spectral_bandwidth": 2, "spectral_flatness": 6, "zero_crossing_rate": 6}
LEVELS, SPECTRAL = ["rms", "energy"], ["spectral_centroid", "spectral_rolloff", "spectral_bandwidth", "spectral_flatness", "zero_crossing_rate"]


def places_of(columns: list[str]) -> dict[str, int]:
    """time_sec with 4 decimals and each metric, of a channel or alone, with its own."""
    metric = lambda c: c.split("_", 1)[1] if c.startswith("chan") else c
    return {c: 4 if c == "time_sec" else PLACES[metric(c)] for c in columns if c == "time_sec" or metric(c) in PLACES}


def write_channels(rows: DataFrame, channels: list, metrics: list[str], path: str, parts: bool = False) -> None:
    """The wide table of frames (time_sec, channel, metrics): RMS and spectral tables."""
    table = wide(rows, "time_sec", "channel", channels, metrics)
    write_ordered(table, path, ["time_sec"], places=places_of(table.columns), parts=parts)


def pitch_table(rows: DataFrame, channels: list) -> DataFrame:
    """Wide pitch rows (channel, idx, time_sec, pitch_hz) as text: empty where unvoiced, "no data" past a channel's end; the time is the first channel's that has the row."""
    parts = [F.max(F.when(F.col("channel") == c, F.struct("pitch_hz"))).alias(f"_c{k}") for k, c in enumerate(channels)]
    place = F.array_position(F.array(*(F.lit(c) for c in channels)), F.col("channel"))
    table = rows.groupBy("idx").agg(F.min_by("time_sec", place).alias("time_sec"), *parts)
    texts = [F.when(F.col(f"_c{k}").isNull(), "no data").otherwise(F.coalesce(fixed(2)(F.col(f"_c{k}.pitch_hz")), F.lit(""))).alias(f"chan{k + 1}_pitch_hz") for k in range(len(channels))]
    return table.select("idx", fixed(4)(F.col("time_sec")).alias("time_sec"), *texts)


def write_pitch(rows: DataFrame, channels: list, path: str, parts: bool = False) -> None:
    """The pitch table of all channels, by the rows' numbers."""
    table = pitch_table(rows, channels)
    write_ordered(table, path, ["idx"], table.columns[1:], parts=parts)


def write_emotions(rows: DataFrame, path: str, parts: bool = False) -> None:
    """Chunks with the probabilities as a list in one cell."""
    write_ordered(rows, path, ["chunk_index"], ["chunk_index", "start_sec", "end_sec", "predicted_emotion", "emotion_probs"], parts=parts)


def write_words(words: DataFrame, path: str, parts: bool = False) -> None:
    """Words (n, time_sec, word) in their order: the time with 4 decimals, and the word; lines end in CR and LF."""
    write_ordered(words, path, ["n"], ["time_sec", "word"], {"time_sec": 4}, "\r\n", parts)


def write_gaze(table: DataFrame, path: str, parts: bool = False) -> None:
    """The feature table of frames in its column order, flags as True and False."""
    write_ordered(table, path, ["frame_idx"], [*ORDER, *(c for c in (f"{m}_smooth" for m in SMOOTHED) if c not in ORDER and c in table.columns)], parts=parts)


def npy_bytes(samples: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """key, npy: a 1-D float32 NPY file of each key's blocks (arrays ``value`` in ``order``); one file is one row, as the format needs."""
    blocks = samples.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda s: s[value]).alias("_b"))

    @F.pandas_udf("binary")
    def pack(s):
        def one(arrays) -> bytes:
            out = io.BytesIO()
            np.save(out, np.concatenate([np.asarray(a, np.float32) for a in arrays]) if len(arrays) else np.zeros(0, np.float32))
            return out.getvalue()

        return s.map(one)

    return blocks.select(*key, pack("_b").alias("npy"))
