"""Transcript operators: nested segments to words, snapped times, runs of one word."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import snap, strip
from cadenza.operators import sequence as S

SEGMENTS = "array<struct<words:array<struct<start:double,word:string>>>>"


def words_of(transcripts: DataFrame, key: list[str], segments: str = "segments") -> DataFrame:
    """key, seq, start, word: the words of all segments in order, without white space at the ends; segments without words are skipped."""
    empty = F.array().cast("array<struct<start:double,word:string>>")
    flat = F.flatten(F.transform(segments, lambda s: F.coalesce(s["words"], empty)))
    rows = transcripts.select(*key, F.posexplode(flat).alias("seq", "w"))
    return rows.select(*key, "seq", F.col("w.start").alias("start"), strip(F.col("w.word")).alias("word"))


def export_words(words: DataFrame, key: list[str], interval: float = 0.2) -> DataFrame:
    """key, n, time_sec, word: words by start (ties as they came), empty ones left out, one row for a run of the same word."""
    some = words.where(F.col("word") != "")
    numbered = S.ordinal(some, key, ["start", "seq"], F.floor(F.col("start") / 600), "n")
    return S.run_dedup(numbered, key, "n", "word").select(*key, "n", snap(F.col("start"), interval).alias("time_sec"), "word")
