"""Container operators: stream checks, size estimates and the manifest of variants to extract.

Running the extraction tool itself is left to ``run_manifest`` with a caller's command runner.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import whole_seconds, without_extension

#: variant, extension, sample rate, filter, codec
AUDIO_VARIANTS = [
    ("whisper", "wav", 16000, "afftdn=nr=20", "pcm_s16le"),
    ("volume", "flac", 22050, None, "flac"),
    ("analysis", "flac", 22050, "afftdn=nr=20,loudnorm", "flac"),
    ("events", "flac", 22050, "loudnorm", "flac"),
    ("emotion", "flac", 16000, "volume=0.5", "flac"),
]
VISION = ["-an", "-vf", "fps=15,scale=224:224", "-c:v", "libx264", "-preset", "fast", "-crf", "16"]


def probed(streams: DataFrame) -> DataFrame:
    """Streams with ``duration_sec`` from a duration text; what is no number counts as 0."""
    return streams.withColumn("duration_sec", whole_seconds(F.col("duration")))


def stream_counts(paths: DataFrame, counts: DataFrame, on: str = "path") -> DataFrame:
    """path, streams: for each path the counts (``on``, streams) of what it is made of, 0 where there are none. Streams are counted before they meet the paths."""
    return paths.select("path", F.col(on).alias("_on")).join(counts.select(F.col(on).alias("_on"), "streams"), "_on", "left").groupBy("path").agg(F.coalesce(F.sum("streams"), F.lit(0)).alias("streams"))


def size_estimates(streams: DataFrame) -> DataFrame:
    """Integer megabytes of each stream's variants: whisper, pcm, flac (40 % of pcm) and whisper + 3 flac."""
    d = "cast(duration_sec as bigint)"
    out = streams.withColumn("whisper_mb", F.expr(f"{d} * 16000 * 2 div 1048576")).withColumn("pcm_mb", F.expr(f"{d} * 22050 * 2 div 1048576"))
    return out.withColumn("flac_mb", F.expr("pcm_mb * 40 div 100")).withColumn("total_mb", F.expr("whisper_mb + 3 * flac_mb"))


def size_totals(streams: DataFrame) -> DataFrame:
    """path, streams, total_mb: the megabytes that all variants of all streams of a path take."""
    return size_estimates(streams).groupBy("path").agg(F.count("*").alias("streams"), F.sum("total_mb").alias("total_mb"))


def some_streams(counts: DataFrame) -> DataFrame:
    """The counts of ``stream_counts``; a path without an audio stream ends the job with an error."""
    bad = F.raise_error(F.concat(F.lit("no audio stream in "), F.coalesce("path", F.lit("null")))).cast("long")
    return counts.withColumn("streams", F.when(F.col("streams") > 0, F.col("streams")).otherwise(bad))


def audio_manifest(streams: DataFrame, out_dir: str) -> DataFrame:
    """One row a stream and variant (five of them): output path and encoder settings."""
    variants = F.array(*(F.struct(F.lit(v).alias("variant"), F.lit(e).alias("ext"), F.lit(r).alias("sample_rate"), F.lit(f).cast("string").alias("filter"), F.lit(c).alias("codec")) for v, e, r, f, c in AUDIO_VARIANTS))
    rows = streams.select("path", "stream_index", F.explode(variants).alias("v")).select("path", "stream_index", "v.*")
    name = without_extension(F.element_at(F.split("path", "/"), -1))
    return rows.withColumn("output", F.concat(F.lit(out_dir.rstrip("/") + "/"), name, F.lit("_stream"), F.col("stream_index").cast("string"), F.lit("_"), F.col("variant"), F.lit("."), F.col("ext")))


def video_manifest(paths: DataFrame, out_dir: str) -> DataFrame:
    """One row a path: the video-only output and its arguments."""
    name = without_extension(F.element_at(F.split("path", "/"), -1))
    return paths.select("path", F.concat(F.lit(out_dir.rstrip("/") + "/"), name, F.lit("_vision.mp4")).alias("output"), F.array(*(F.lit(a) for a in VISION)).alias("arguments"))


def run_manifest(manifest: DataFrame, runner: Callable[[dict], int], confirm: bool = False) -> DataFrame:
    """The manifest with ``status`` of each row; nothing runs unless ``confirm`` is true (status null)."""
    if not confirm:
        return manifest.withColumn("status", F.lit(None).cast("int"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf.assign(status=[int(runner(r)) for r in pdf.to_dict("records")])

    return manifest.mapInPandas(run, manifest.withColumn("status", F.lit(0)).schema)
