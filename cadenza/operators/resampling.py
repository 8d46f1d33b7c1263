"""Resampling of signals of any length by a polyphase filter bank, a block at a time.

Output sample m lies at input place m * from / to. Its value is the dot product of the samples around that place with the taps of one of
a few phases (a windowed sinc, the same for all signals). A block gives the outputs whose samples it holds all of without meeting any other; of the
outputs near its ends it gives partial sums, and only these are shuffled and added up. No signal is ever one row, and the
result is the same for blocks of any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Zero crossings of the sinc on either side, and outputs computed at a time.
ZEROS, AT_ONCE = 8, 1 << 15


def filter_bank(from_rate: int, to_rate: int, zeros: int = ZEROS) -> tuple[int, int, np.ndarray]:
    """(up, down, taps): output m takes taps[m * down % up] over the samples from m * down // up - half + 1 on, half = taps per phase / 2.

    The lower of both rates sets the band; a Hann window ends the sinc, and each phase sums to 1.
    """
    if from_rate < 1 or to_rate < 1:
        raise ValueError(f"rates must be over 0, not {from_rate} and {to_rate}")
    g = math.gcd(from_rate, to_rate)
    up, down = to_rate // g, from_rate // g
    band = min(1.0, up / down)
    reach = zeros / band
    half = math.ceil(reach)
    u = np.arange(up)[:, None] / up - (np.arange(2 * half)[None, :] - half + 1)
    taps = np.where(np.abs(u) < reach, np.sinc(band * u) * (0.5 + 0.5 * np.cos(np.pi * u / reach)), 0.0)
    return up, down, taps / taps.sum(1, keepdims=True)


def sums(x: np.ndarray, start: int, m: np.ndarray, up: int, down: int, taps: np.ndarray) -> np.ndarray:
    """For outputs m, the part of their dot products that the samples x from place ``start`` on give."""
    width = taps.shape[1]
    padded = np.pad(x, width)
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)
    out = np.empty(len(m))
    for at in range(0, len(m), AT_ONCE):
        some = m[at : at + AT_ONCE]
        first = some * down // up - width // 2 + 1 - start + width
        out[at : at + AT_ONCE] = np.einsum("ij,ij->i", windows[first], taps[some * down % up])
    return out


def resample(blocks: DataFrame, key: list[str], start: str, samples: str, from_rate: int, to_rate: int) -> DataFrame:
    """key, n (long), value: the samples of each key at another rate, from its blocks (place of the first sample, array) in any order.

    A signal of N samples has ceil(N * to / from) outputs; beyond its ends it is silent. Null samples count as 0; a null or empty block, or one without a place, gives nothing.
    """
    fields = [blocks.schema[k] for k in key]
    up, down, taps = filter_bank(from_rate, to_rate)
    half = taps.shape[1] // 2

    def outputs(edges: bool):
        schema = T.StructType([*fields, T.StructField("_at", T.LongType()), T.StructField("_values", T.ArrayType(T.DoubleType())), T.StructField("_own", T.BooleanType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(len(batch)):
                    place, array = batch.column(len(key))[k].as_py(), batch.column(len(key) + 1)[k]
                    if place is None or not array.is_valid or not len(array):
                        continue
                    x = array.values.fill_null(0.0).to_numpy(zero_copy_only=False).astype(float)
                    end = place + len(x)
                    own = -(-place * up // down), -(-end * up // down)  # the outputs that lie in the block
                    touched = max(0, -(-(place - half) * up // down)), -(-(end + half - 1) * up // down)
                    whole = max(touched[0], -(-(place + half - 1) * up // down)), -(-(end - half) * up // down)
                    whole = (whole[0], max(whole))
                    parts = [(*whole, True)] if not edges else [(a, b, flag) for a, b, flag in ((touched[0], min(own[0], whole[0]), False), (max(touched[0], min(own[0], whole[0])), whole[0], True), (whole[1], max(own[1], whole[1]), True), (max(own[1], whole[1]), touched[1], False)) if a < b]
                    if edges and whole[0] == whole[1]:  # no output is whole: all that are touched, owned or not
                        parts = [(touched[0], own[0], False), (*own, True), (own[1], touched[1], False)]
                    for a, b, flag in parts:
                        if a < b:
                            keys = [batch.column(c).slice(k, 1) for c in range(len(key))]
                            values = pa.array([sums(x, place, np.arange(a, b), up, down, taps).tolist()], pa.list_(pa.float64()))
                            yield pa.RecordBatch.from_arrays([*keys, pa.array([a], pa.int64()), values, pa.array([flag])], names=schema.names)

        rows = blocks.select(*key, F.col(start).cast("long"), F.col(samples).cast("array<double>")).mapInArrow(run, schema)
        return rows.select(*key, "_at", F.posexplode("_values").alias("_k", "value"), "_own").select(*key, (F.col("_at") + F.col("_k")).alias("n"), "value", "_own")

    if up == down:
        flat = blocks.where(F.col(start).isNotNull()).select(*key, F.col(start).cast("long").alias("_at"), F.posexplode(F.col(samples).cast("array<double>")).alias("_k", "value"))
        return flat.select(*key, (F.col("_at") + F.col("_k")).alias("n"), F.coalesce("value", F.lit(0.0)).alias("value"))
    near = outputs(True).groupBy(*key, "n").agg(F.sum("value").alias("value"), F.bool_or("_own").alias("_own")).where("_own").drop("_own")
    return outputs(False).drop("_own").unionByName(near)


def blocks_of(samples: DataFrame, key: list[str], n: str, value: str, size: int) -> DataFrame:
    """key, block_start, samples: numbered samples (gapless) in blocks of ``size``."""
    parts = samples.groupBy(*key, F.floor(F.col(n) / size).cast("long").alias("_block")).agg(F.array_sort(F.collect_list(F.struct(F.col(n).alias("n"), F.col(value).cast("double").alias("v")))).alias("_s"))
    return parts.select(*key, (F.col("_block") * size).alias("block_start"), F.transform("_s", lambda s: s["v"]).alias("samples"))
