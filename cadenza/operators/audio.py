"""Audio operators: framing, chunking, levels and spectra of numbered samples or of sample arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions import arrays as A
from cadenza.operators.sequence import same_key

FRAME_SEC, CHUNK_SEC, TARGET_RMS, SILENCE = 0.025, 5.0, 0.1, 1e-6


def frame_length(sample_rate: int) -> int:
    """int(0.025 s); a rate under 40 has no frame."""
    n = int(FRAME_SEC * sample_rate)
    if n < 1:
        raise ValueError(f"a sample rate of {sample_rate} gives empty frames")
    return n


def frame_levels(samples: DataFrame, key: list[str], n: str, value: str, length: int, sample_rate: int) -> DataFrame:
    """One row a frame of ``length`` samples (the last may be short): frame_idx, time_sec, n_samples, rms, energy.

    Squares are added in the order of ``n``, so that an energy has the same bits however the samples are dealt over tasks.
    """
    v = F.col(value)
    rows = samples.select(*key, F.floor(F.col(n) / length).cast("long").alias("frame_idx"), F.col(n).alias("_n"), (v * v).alias("_square"))
    upto = Window.partitionBy(*key, "frame_idx").orderBy("_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A running sum of squares never falls: its last value is its greatest.
    out = rows.withColumn("_energy", F.sum("_square").over(upto)).groupBy(*key, "frame_idx").agg(F.count("*").alias("n_samples"), F.max("_energy").alias("energy"))
    return out.select(*key, "frame_idx", (F.col("frame_idx") * length / F.lit(float(sample_rate))).alias("time_sec"), "n_samples", F.sqrt(F.col("energy") / F.col("n_samples")).alias("rms"), "energy")


def chunk_bounds(sizes: DataFrame, size: str, sample_rate: int, chunk_sec: float = CHUNK_SEC) -> DataFrame:
    """One row a chunk of a signal of ``size`` samples: chunk_index, start_sec, end_sec (at most the signal's length)."""
    step = int(sample_rate * chunk_sec)
    rows = sizes.where(F.col(size) > 0).withColumn("chunk_index", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(size) - 1) / step))))
    return rows.withColumn("start_sec", F.col("chunk_index") * F.lit(chunk_sec)).withColumn("end_sec", F.least((F.col("chunk_index") + 1) * F.lit(chunk_sec), F.col(size) / F.lit(float(sample_rate))))


def overlapped(samples: DataFrame, n: str, chunk: int, halo: int) -> DataFrame:
    """Each sample in its chunk and, within ``halo`` samples after a chunk's end, in that chunk too: chunk_idx. Nothing is joined."""
    own = F.floor(F.col(n) / chunk).cast("long")
    first = F.greatest(F.lit(0).cast("long"), F.floor((F.col(n) - halo) / chunk).cast("long"))
    return samples.withColumn("chunk_idx", F.explode_outer(F.sequence(F.least(first, own), own)))  # without a number, in no chunk


def audible(samples: DataFrame, key: list[str], value: str, threshold: float = SILENCE) -> DataFrame:
    """has_audio of each key: whether any sample is over the threshold."""
    return samples.groupBy(*key).agg(F.bool_or(F.abs(value) > threshold).alias("has_audio"))


def normalise(samples: DataFrame, key: list[str], value: str, target: float = TARGET_RMS) -> DataFrame:
    """``normalised``: samples at the target RMS, cut to [-1, 1]; near-silent signals keep their level."""
    level = samples.groupBy(*key).agg(F.sqrt(F.avg(F.col(value) * F.col(value))).alias("_rms"))
    gain = F.when(F.col("_rms") > 1e-8, F.lit(target) / F.col("_rms")).otherwise(1.0)
    return same_key(samples, level, key).withColumn("normalised", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col(value) * gain))).drop("_rms")


def longest(samples: DataFrame, key: list[str]) -> DataFrame:
    """One row, max_len: how many samples the longest signal has, 0 where there is none."""
    return samples.groupBy(*key).agg(F.count("*").alias("_n")).agg(F.coalesce(F.max("_n"), F.lit(0)).alias("max_len"))


def signal_stats(samples: DataFrame, key: list[str], value: str) -> DataFrame:
    return samples.groupBy(*key).agg(F.count("*").alias("length"), F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"))


def spectral_features(frames: DataFrame, frame: str, sample_rate: int, fft_size: int) -> DataFrame:
    """Centroid, rolloff, bandwidth, flatness and zero-crossing rate of frames held as arrays.

    The window spans the padded length and the crossings are counted on the raw frame.
    """
    m = F.col("_m")
    out = frames.withColumn("_m", A.magnitudes(A.hamming(A.pad(F.col(frame), fft_size), fft_size)))
    out = out.withColumn("spectral_centroid", A.centroid(m, sample_rate))
    out = out.withColumn("spectral_rolloff", A.rolloff(m, sample_rate)).withColumn("spectral_bandwidth", A.bandwidth(m, sample_rate, F.col("spectral_centroid")))
    return out.withColumn("spectral_flatness", A.flatness(m)).withColumn("zero_crossing_rate", A.zero_crossing_rate(F.col(frame))).drop("_m")


def frames_of(blocks: DataFrame, samples: str, length: int) -> DataFrame:
    """Frames of blocks whose size is a multiple of ``length``, so that none crosses a block: frame_idx in the signal, frame."""
    start = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(samples) - 1), F.lit(length))
    rows = blocks.where(F.size(samples) > 0).withColumn("_at", F.explode(start))
    return rows.withColumn("frame", A.chunk_at(F.col(samples), F.col("_at"), length)).withColumn("frame_idx", ((F.col("block_start") + F.col("_at")) / length).cast("long")).drop("_at")


def wide(rows: DataFrame, time: str, channel: str, channels: list, metrics: list[str], prefix: str = "chan") -> DataFrame:
    """One row a time, columns chan1_metric, chan1_other, chan2_metric ...; frames that a channel lacks are null."""
    parts = [F.max(F.when(F.col(channel) == c, F.col(m))).alias(f"{prefix}{k + 1}_{m}") for k, c in enumerate(channels) for m in metrics]
    return rows.groupBy(time).agg(*parts)


def found_channels(rows: DataFrame, channel: str, most: int = 256) -> list:
    """The channels that there are, in order; an error if there are more than ``most``, or a null one."""
    got = [r[0] for r in rows.select(channel).distinct().take(most + 1)]
    if len(got) > most:
        raise ValueError(f"more than {most} channels")
    if None in got:
        raise ValueError("a channel without a name")
    return sorted(got)


def wide_found(rows: DataFrame, key: list[str], time: str, channel: str, metrics: list[str], most: int = 256, block: int = 4096, prefix: str = "chan") -> DataFrame:
    """``wide`` for channels not known beforehand: a pass finds them and shapes the schema, then each block of ``block`` times is laid out as columns by one task.

    ``time`` is a whole number; rows without one are left out. chan1 is the least channel. The columns are doubles, null where a channel
    lacks the time; of several values for one cell the greatest is kept.
    """
    channels = found_channels(rows, channel, most)
    names = [f"{prefix}{c + 1}_{m}" for c in range(len(channels)) for m in metrics]
    place = {c: k for k, c in enumerate(channels)}
    schema = T.StructType([*(rows.schema[k] for k in key), T.StructField(time, T.LongType()), *(T.StructField(c, T.DoubleType()) for c in names)])

    def lay(table: pa.Table) -> pa.Table:
        times, at = np.unique(table.column(time).to_numpy(), return_inverse=True)
        column = np.array([place[c] for c in table.column(channel).to_pylist()], int) * len(metrics)
        grid = np.full((len(names), len(times)), np.nan)
        for k, m in enumerate(metrics):
            v = table.column(m).to_numpy()
            some = ~np.isnan(v)
            np.fmax.at(grid, (column[some] + k, at[some]), v[some])
        keys = [pa.array([table.column(k)[0].as_py()] * len(times), table.column(k).type) for k in key]
        return pa.table([*keys, pa.array(times), *(pa.array(row, from_pandas=True) for row in grid)], names=schema.names)

    some = rows.select(*key, F.col(time).cast("long").alias(time), channel, *(F.coalesce(F.col(m).cast("double"), F.lit(float("nan"))).alias(m) for m in metrics)).where(F.col(time).isNotNull())
    return some.groupBy(*key, F.floor(F.col(time) / block)).applyInArrow(lay, schema)


def mono_of(channels: Column) -> Column:
    """The mean over an array of channel arrays of equal length."""
    return F.transform(channels[0], lambda _, i: A.fold(F.transform(channels, lambda c: F.get(c, i))) / F.size(channels))
