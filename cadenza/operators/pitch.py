"""Pitch of chunks of a channel: probabilistic YIN (Mauch and Dixon, 2014), one chunk with its halo at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.audio import CHUNK_SEC, frame_length
from cadenza.operators.timeline import on_timeline

FMIN, FMAX = 60.0, 600.0
#: Thresholds with a Beta(2, 18) prior, pitch bins a semitone, and how far the pitch may move in one hop (semitones).
THRESHOLDS, BINS, REACH, NO_TROUGH, SWITCH = 100, 10, 3, 0.01, 0.01


def _difference(frames: np.ndarray, lags: int) -> np.ndarray:
    """The cumulative-mean-normalised difference of each frame for lags 0 .. lags."""
    n = frames.shape[1] - lags
    head = np.fft.rfft(frames[:, :n], 2 * frames.shape[1])
    acf = np.fft.irfft(np.conj(head) * np.fft.rfft(frames, 2 * frames.shape[1]))[:, : lags + 1]
    power = np.cumsum(np.pad(frames**2, ((0, 0), (1, 0))), axis=1)
    energy = power[:, n : n + lags + 1] - power[:, : lags + 1]
    d = np.maximum(energy[:, :1] + energy - 2 * acf, 0)
    d[:, 0] = 0
    mean = np.cumsum(d, axis=1)[:, 1:] / np.arange(1, lags + 1)
    out = np.ones_like(d)
    np.divide(d[:, 1:], mean, out=out[:, 1:], where=mean > 1e-20)
    return out


def pyin(x: np.ndarray, sample_rate: int, fmin: float = FMIN, fmax: float = FMAX, frame: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(times, pitch in Hz or NaN) of a signal; frames are centred on multiples of a quarter frame, zeros around the ends."""
    # Frames must hold two periods of the lowest pitch.
    frame = max(frame or frame_length(sample_rate), int(2 * sample_rate / fmin) + 2)
    hop = max(1, frame_length(sample_rate) // 4)
    padded = np.pad(np.asarray(x, float), frame // 2)
    count = 1 + (len(padded) - frame) // hop
    if count < 1:
        return np.zeros(0), np.zeros(0)
    frames = np.lib.stride_tricks.sliding_window_view(padded, frame)[::hop][:count]
    lo, hi = max(2, int(sample_rate / fmax)), min(int(np.ceil(sample_rate / fmin)), frame // 2)
    d = _difference(frames, hi)
    limit = np.linspace(0, 1, THRESHOLDS + 1)[1:]
    prior = limit * (1 - limit) ** 17
    prior /= prior.sum()
    n_bins = int(np.ceil(12 * np.log2(fmax / fmin) * BINS)) + 1
    voiced = np.zeros((count, n_bins))
    for t in range(count):
        y = d[t, lo - 1 : hi + 1]
        trough = np.flatnonzero((y[1:-1] < y[:-2]) & (y[1:-1] <= y[2:])) + 1
        if not len(trough):
            continue
        depth = y[trough]
        below = depth[:, None] < limit[None, :]
        first = below & (np.cumsum(below, axis=0) == 1)
        p = (first * prior).sum(1)
        p[depth.argmin()] += NO_TROUGH * prior[~below.any(0)].sum()
        a, b, c = y[trough - 1], depth, y[trough + 1]
        bend = a - 2 * b + c
        lag = trough + lo - 1 + np.divide(a - c, 2 * bend, out=np.zeros_like(b), where=np.abs(bend) > 1e-12)
        at = np.clip(np.round(12 * BINS * np.log2(sample_rate / lag / fmin)), 0, n_bins - 1).astype(int)
        np.add.at(voiced[t], at, p)
    reach = REACH * BINS
    step = reach + 1 - np.abs(np.arange(-reach, reach + 1))
    log_step = np.log(step / step.sum())
    unvoiced = np.maximum(1 - voiced.sum(1), 1e-12)
    stay, turn = np.log(1 - SWITCH), np.log(SWITCH)
    # Viterbi over (bin, voiced or not); the two layers move alike.
    score = np.log(np.stack([voiced[0] + 1e-12, np.full(n_bins, unvoiced[0] / n_bins)]) / (2 * n_bins))
    back = np.zeros((count, 2, n_bins), np.int32)
    place = np.arange(n_bins)
    for t in range(1, count):
        wide = np.pad(score, ((0, 0), (reach, reach)), constant_values=-np.inf)
        moves = np.lib.stride_tricks.sliding_window_view(wide, 2 * reach + 1, axis=1) + log_step
        best = moves.argmax(2)
        value = np.take_along_axis(moves, best[:, :, None], 2)[:, :, 0]
        source = place[None, :] + best - reach
        new = np.empty_like(score)
        for v in (0, 1):
            keep, change = value[v] + stay, value[1 - v] + turn
            new[v] = np.maximum(keep, change)
            back[t, v] = np.where(keep >= change, source[v] + v * n_bins, source[1 - v] + (1 - v) * n_bins)
        score = new + np.log(np.stack([voiced[t] + 1e-12, np.full(n_bins, unvoiced[t] / n_bins)]))
    state = int(score.reshape(-1).argmax())
    pitch = np.full(count, np.nan)
    for t in range(count - 1, -1, -1):
        if state < n_bins:
            pitch[t] = fmin * 2 ** (state / (12 * BINS))
        state = int(back[t].reshape(-1)[state])
    return np.arange(count) * hop / sample_rate, pitch


def pitch_of_chunks(chunks: DataFrame, key: list[str], samples: str, sample_rate: int, dedup_overlap: bool = False) -> DataFrame:
    """key, chunk_idx, idx, time_sec, pitch_hz (null: unvoiced) of chunks (key, chunk_idx, start, samples with their halo), on the timeline of the signal.

    Chunks are independent rows: no task holds more than one batch of them. The halo's hops come twice unless ``dedup_overlap``.
    """
    if not 0 < FMAX < sample_rate / 2:
        raise ValueError(f"a sample rate of {sample_rate} has no pitch up to {FMAX} Hz")

    @F.pandas_udf("struct<times:array<double>,values:array<double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = [pyin(np.asarray(x, float), sample_rate) for x in s]
            yield pd.DataFrame({"times": [t for t, _ in rows], "values": [f for _, f in rows]})

    found = chunks.select(*key, "chunk_idx", "start", run(samples).alias("_f"))
    out = on_timeline(found, key, F.col("_f.times"), F.col("_f.values"), sample_rate, int(CHUNK_SEC * sample_rate) if dedup_overlap else None)
    return out.withColumnRenamed("value", "pitch_hz")
