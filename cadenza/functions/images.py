"""Images in batches: bilinear resizing, separable, with pixel centres at half numbers and edges repeated; no smoothing before."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def taps(size: int, out: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each output place: the two input places and the weight of the second. The two non-zeros of a row of the sparse matrix."""
    at = np.clip((np.arange(out) + 0.5) * (size / out) - 0.5, 0, size - 1)
    low = np.floor(at).astype(int)
    return low, np.minimum(low + 1, size - 1), at - low


def resize(images: np.ndarray, height: int, width: int) -> np.ndarray:
    """Images [n, h, w] or [n, h, w, c] at another size, as doubles."""
    for axis, out in ((1, height), (2, width)):
        if images.shape[axis] != out:
            a, b, share = taps(images.shape[axis], out)
            share = share.reshape([-1 if k == axis else 1 for k in range(images.ndim)])
            images = np.take(images, a, axis) * (1 - share) + np.take(images, b, axis) * share
    return images.astype(float, copy=False)


def resized(pixels: Column, size: tuple[int, int], out: tuple[int, int]) -> Column:
    """Row-major maps of size (h, w) at size ``out``. Null, and an array of another length, give null."""
    (h, w), n = size, size[0] * size[1]

    @F.pandas_udf("array<double>")
    def run(s: pd.Series) -> pd.Series:
        fits = [k for k, a in enumerate(s) if a is not None and len(a) == n]
        got: list = [None] * len(s)
        if fits:
            batch = np.stack([s.iloc[k] for k in fits]).astype(float).reshape(-1, h, w)
            for k, image in zip(fits, resize(batch, *out), strict=True):
                got[k] = image.ravel()
        return pd.Series(got, index=s.index, dtype=object)

    return run(pixels)


def matrix(column: pa.Array, at: np.ndarray) -> np.ndarray | None:
    """The arrays or bytes at some places of a column as rows of one matrix of doubles; None unless all are there, whole and of one length."""
    part = column.take(pa.array(at))
    if part.null_count or not len(at):
        return None
    if pa.types.is_binary(part.type) or pa.types.is_large_binary(part.type):
        rows = [np.frombuffer(b.as_buffer(), np.uint8) for b in part]
        return np.stack(rows).astype(float) if len({len(r) for r in rows}) == 1 else None
    flat = part.flatten()
    if flat.null_count or len(set(part.value_lengths().to_pylist())) != 1:
        return None
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(at), -1)
