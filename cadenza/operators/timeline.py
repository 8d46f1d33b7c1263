"""What any function of a chunk gives, on the timeline of the whole signal.

Chunks overlap by a halo, so that their edges are seen whole. A function gives times within the chunk and values; these are paired by
position, moved to global time and put one chunk after the other. The halo's rows come twice, as in the chunks, unless each moment is left to
the chunk whose own interval holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators import audio
from cadenza.operators.sequence import same_key


def chunks_of(samples: DataFrame, key: list[str], n: str, value: str, chunk: int, halo: int) -> DataFrame:
    """key, chunk_idx, start, samples: numbered samples in chunks with their halo."""
    rows = audio.overlapped(samples, n, chunk, halo).where(F.col("chunk_idx").isNotNull())
    parts = rows.groupBy(*key, "chunk_idx").agg(F.array_sort(F.collect_list(F.struct(F.col(n).alias("n"), F.col(value).alias("v")))).alias("_s"))
    return parts.select(*key, "chunk_idx", (F.col("chunk_idx") * chunk).alias("start"), F.transform("_s", lambda s: s["v"]).alias("samples"))


def on_timeline(chunks: DataFrame, key: list[str], times: Column, values: Column, sample_rate: int, chunk: int | None = None) -> DataFrame:
    """key, idx, chunk_idx, time_sec, value of chunks (key, chunk_idx, start, ...).

    ``times`` (seconds in the chunk) and ``values`` are arrays of each chunk; the shorter one ends the pairs, and NaN becomes null. ``idx``
    numbers a key's rows in order of chunk and place. With ``chunk`` (samples) a moment is kept only by the chunk whose own interval holds it; a key's last chunk has no
    next one to leave it to, but its halo is empty. Chunks without pairs give nothing. Rows are exploded once; only a count of each chunk is ordered.
    """
    pairs = F.arrays_zip(times.alias("t"), values.alias("v"))
    rows = chunks.select(*key, "chunk_idx", "start", F.slice(pairs, 1, F.least(F.size(times), F.size(values))).alias("_p"))
    if chunk is not None:
        rows = rows.withColumn("_p", F.filter("_p", lambda p: p["t"] < F.lit(chunk / sample_rate)))
    rows = rows.where(F.size("_p") > 0)
    counts = rows.select(*key, "chunk_idx", F.size("_p").cast("long").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(*key).orderBy("chunk_idx")) - F.col("_n")).drop("_n")
    placed = same_key(rows, before, [*key, "chunk_idx"]).select(*key, "chunk_idx", "start", "_before", F.posexplode("_p").alias("_k", "_q"))
    value = F.col("_q.v").cast("double")
    return placed.select(
        *key, (F.col("_before") + F.col("_k")).cast("long").alias("idx"), "chunk_idx",
        (F.col("_q.t") + F.col("start") / F.lit(float(sample_rate))).alias("time_sec"), F.when(~F.isnan(value), value).alias("value"),
    )
