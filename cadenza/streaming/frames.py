"""Frame levels of a stream of sample blocks (beyond the batch operators: each block is complete in itself)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import arrays as A
from cadenza.operators.audio import frames_of


def stream_levels(blocks: DataFrame, length: int, sample_rate: int) -> DataFrame:
    """path, channel, frame_idx, time_sec, rms, energy of a streaming (or plain) DataFrame of blocks; no state is kept, as no frame crosses a block."""
    frames = frames_of(blocks, "samples", length)
    energy = A.fold(F.col("frame"), lambda x: x * x)
    rows = frames.withColumn("energy", energy).withColumn("rms", F.sqrt(F.col("energy") / F.size("frame")))
    return rows.select("path", "channel", "frame_idx", (F.col("frame_idx") * length / F.lit(float(sample_rate))).alias("time_sec"), "rms", "energy")
