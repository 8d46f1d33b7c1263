"""Column functions over one frame, chunk or map held as an array. All stay in the JVM but the FFT."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FULL_SCALE = 2147483647.0


def div(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den where den > 0, else the default: ANSI mode never sees a division by zero."""
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def let(x: Column, f) -> Column:
    """f(x) with x computed once: an expression inside a lambda would be computed for each element."""
    return F.element_at(F.transform(F.array(x), f), 1)


def fold(a: Column, value=lambda x: x) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + value(x))


def doubles(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double"))


def full_scale(samples: Column) -> Column:
    """Integer samples over 2**31 - 1, whatever their depth."""
    return F.transform(samples, lambda s: s / F.lit(FULL_SCALE))


def bit_depth_scale(samples: Column, bits: Column) -> Column:
    """Integer samples over 2**(bits - 1), in 64 bits so that 32-bit audio keeps its sign."""
    return F.transform(samples, lambda s: s.cast("double") / F.pow(F.lit(2.0), bits - 1))


def channel_of(interleaved: Column, channels: int, c: int) -> Column:
    """Every ``channels``-th sample from sample c on."""
    return F.filter(interleaved, lambda _, i: i % channels == c)


def mono(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: (a + b) / 2)


def pad(a: Column, size: int) -> Column:
    """Zeros after the array up to ``size``; a longer array stays as it is."""
    return F.concat(a, F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), F.lit(size) - F.size(a))))


def chunk_at(a: Column, start: Column, length: int) -> Column:
    return F.slice(a, start + 1, F.lit(length))


def centred_frames(a: Column, length: int, hop: int) -> Column:
    """Frames of ``length`` around every multiple of ``hop``, zeros beyond the ends: 1 + size / hop of them."""
    zeros = F.array_repeat(F.lit(0.0), length // 2)
    starts = F.sequence(F.lit(0), F.floor((F.size(a) + 2 * (length // 2) - length) / hop).cast("int"))
    return let(F.concat(zeros, a, zeros), lambda x: F.transform(starts, lambda k: F.slice(x, k * hop + 1, F.lit(length))))


def next_power_of_two(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def hamming(a: Column, n: int) -> Column:
    """A Hamming window of n points over an array of n (the padded length)."""
    return F.transform(a, lambda v, i: v * (F.lit(0.54) - F.lit(0.46) * F.cos(F.lit(2 * math.pi) * i / F.lit(float(n - 1)))))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def magnitudes(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Magnitudes of bins [0, n / 2) of the forward FFT; frames of one length are transformed as one matrix."""
    for s in frames:
        out = pd.Series([None] * len(s), index=s.index, dtype=object)
        sizes = s.map(lambda a: len(a) if a is not None else -1)
        for n in sizes.unique():
            if n < 0:
                continue
            at = sizes.index[sizes == n]
            m = np.abs(np.fft.fft(np.stack(s[at].to_numpy()).astype(float), axis=1))[:, : n // 2] if n else np.zeros((len(at), 0))
            for k, row in zip(at, m, strict=True):
                out[k] = row
        yield out


def frequency(i: Column, sample_rate: int, bins: Column) -> Column:
    return i * F.lit(float(sample_rate)) / (2.0 * bins)


def centroid(m: Column, sample_rate: int) -> Column:
    weighted = fold(F.transform(m, lambda v, i: v * frequency(i, sample_rate, F.size(m))))
    return div(weighted, fold(m))


def bandwidth(m: Column, sample_rate: int, c: Column) -> Column:
    def spread(c: Column) -> Column:
        return fold(F.transform(m, lambda v, i: v * F.pow(frequency(i, sample_rate, F.size(m)) - c, 2)))

    return F.sqrt(div(let(c, spread), fold(m)))


def rolloff(m: Column, sample_rate: int, share: float = 0.85) -> Column:
    """The first bin at which the running energy reaches the share of the total; half the rate if none does."""
    zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("i"), F.lit(-1).alias("at"))

    def reach(limit: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            total = acc["sum"] + x * x
            return F.struct(total.alias("sum"), (acc["i"] + 1).alias("i"), F.when((acc["at"] < 0) & (total >= limit), acc["i"]).otherwise(acc["at"]).alias("at"))

        return F.aggregate(m, zero, step, lambda acc: acc["at"])

    at = let(fold(m, lambda x: x * x) * share, reach)
    return let(at, lambda at: F.when(at < 0, F.lit(sample_rate / 2.0)).otherwise(frequency(at, sample_rate, F.size(m))))


def flatness(m: Column) -> Column:
    """Geometric over arithmetic mean; zeros are left out of the logarithms but counted in both means."""
    n = F.size(m).cast("double")
    logs = fold(F.filter(m, lambda x: x > 0), F.ln)
    mean = div(fold(m), n)
    return F.when(mean > 0, F.exp(div(logs, n)) / mean).otherwise(0.0)


def zero_crossing_rate(frame: Column) -> Column:
    """Sign changes (0 counts as positive) over n - 1; 0 for fewer than two samples."""
    n = F.size(frame)
    changes = F.aggregate(
        frame,
        F.struct(F.lit(0).alias("n"), F.lit(None).cast("boolean").alias("last")),
        lambda acc, x: F.struct((acc["n"] + F.when(acc["last"].isNotNull() & (acc["last"] != (x >= 0)), 1).otherwise(0)).alias("n"), (x >= 0).alias("last")),
        lambda acc: acc["n"],
    )
    return F.when(n < 2, 0.0).otherwise(changes / F.greatest(F.lit(1), n - 1))


def softmax(a: Column) -> Column:
    powers = let(F.array_max(a), lambda top: F.transform(a, lambda x: F.exp(x - top)))
    return let(powers, lambda e: let(fold(e), lambda total: F.transform(e, lambda x: x / total)))


def argmax(a: Column) -> Column:
    """The first place of the maximum, from 0."""
    return F.array_position(a, F.array_max(a)) - 1


def label_of(probabilities: Column, labels: list[str]) -> Column:
    return F.element_at(F.array(*(F.lit(x) for x in labels)), (argmax(probabilities) + 1).cast("int"))


def mean(a: Column) -> Column:
    return div(fold(a), F.size(a).cast("double"))


def std_pop(a: Column) -> Column:
    return F.sqrt(div(let(mean(a), lambda m: fold(a, lambda x: (x - m) * (x - m))), F.size(a).cast("double")))


def percentile(a: Column, q: float) -> Column:
    """Linear interpolation between the two nearest ranks."""
    at = (F.size(a) - 1) * F.lit(q)
    low = F.floor(at).cast("int")

    def between(s: Column) -> Column:
        lo, hi = F.element_at(s, low + 1), F.element_at(s, F.least(low + 2, F.size(s)))
        return lo + (hi - lo) * (at - low)

    return let(F.array_sort(a), between)


def entropy(a: Column, epsilon: float = 1e-10) -> Column:
    shares = let(fold(a, lambda x: x + epsilon), lambda total: F.transform(a, lambda x: (x + epsilon) / total))
    return -fold(shares, lambda p: p * F.log2(p))


def centre(a: Column, width: int, height: int) -> tuple[Column, Column]:
    """The centre of mass of a row-major map as shares of width and height; 0.5, 0.5 without mass."""
    total = fold(a)
    x = fold(F.transform(a, lambda v, i: v * (i % width)))
    y = fold(F.transform(a, lambda v, i: v * F.floor(i / width)))
    return F.when(total > 0, x / total / width).otherwise(0.5), F.when(total > 0, y / total / height).otherwise(0.5)


def concentration(a: Column, width: int, height: int, cx: Column, cy: Column) -> Column:
    """1 less the mean distance to the centre over half the diagonal; 0 without mass."""
    total = fold(a)

    def far(c: Column) -> Column:
        return fold(F.transform(a, lambda v, i: v * F.sqrt(F.pow(F.floor(i / width) - c["y"], 2) + F.pow(i % width - c["x"], 2))))

    away = let(F.struct((cx * width).alias("x"), (cy * height).alias("y")), far)
    return F.when(total > 0, 1.0 - away / total / F.lit(math.sqrt(width**2 + height**2) / 2)).otherwise(0.0)


def top_mass(a: Column, q: float = 0.9) -> Column:
    """The share of the mass in values at or over the percentile; 0 without mass."""
    total = fold(a)
    return F.when(total > 0, let(percentile(a, q), lambda p: fold(F.filter(a, lambda x: x >= p))) / total).otherwise(0.0)


def round6(c: Column) -> Column:
    """Half to even at six decimals."""
    return F.bround(c, 6)
