"""Model operators: a caller's model runs in iterator UDFs, loaded once in a Python worker.

A loader is a function without arguments that returns a callable over a list of numpy arrays; the weights of
the public models aren't part of this repository.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import arrays as A

EMOTIONS = ["neutral", "happy", "excited", "sad", "angry"]
MIN_SAMPLES = 1600


def scores(df: DataFrame, column: str, loader: Callable[[], Callable], out: str) -> DataFrame:
    """``out``: what the model gives for each array (logits or a map), a batch at a time."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loader()
        for s in batches:
            yield pd.Series([np.asarray(x, float).ravel() for x in model([np.asarray(a, float) for a in s])], dtype=object)

    return df.withColumn(out, run(F.col(column)))


def emotions(chunks: DataFrame, samples: str, loader: Callable[[], Callable], labels: list[str] | None = None) -> DataFrame:
    """predicted_emotion and emotion_probs (softmax) of non-empty chunks; short ones are filled with zeros to 0.1 s."""
    some = chunks.where(F.size(samples) > 0).withColumn("_padded", A.pad(F.col(samples), MIN_SAMPLES))
    out = scores(some, "_padded", loader, "_logits").withColumn("emotion_probs", A.softmax(F.col("_logits")))
    return out.withColumn("predicted_emotion", A.label_of(F.col("emotion_probs"), labels or EMOTIONS)).drop("_padded", "_logits")


def saliency_maps(frames: DataFrame, pixels: str, loader: Callable[[], Callable]) -> DataFrame:
    """``saliency``: the softmax over all places of the model's map of each frame. Every batch is finished, the last too."""
    return scores(frames, pixels, loader, "_map").withColumn("saliency", A.softmax(F.col("_map"))).drop("_map")


def transcripts(audio: DataFrame, path: str, loader: Callable[[], Callable]) -> DataFrame:
    """``segments`` of each path: the model takes a path and returns segments of words (dictionaries)."""
    from cadenza.operators.transcript import SEGMENTS

    @F.pandas_udf(SEGMENTS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loader()
        for s in batches:
            yield pd.Series([model(p) for p in s], dtype=object)

    return audio.withColumn("segments", run(F.col(path)))
