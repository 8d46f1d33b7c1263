"""Words and shingles of whole batches of texts as 64-bit hashes, without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D, as in ``[^\\x20\\x09-\\x0D]+`` over
UTF-8 (all separators are single bytes, so bytes and code points give the same words).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SHINGLE = 5
_RNG = np.random.default_rng(20240229)
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: list[np.ndarray] = []
#: Bytes of text hashed in one go; longer texts are hashed in parts of whole words.
BLOCK = 1 << 18
#: A factor for each place in a word, as many as places that most words have.
PLACES = 1 << 12


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, mod 2**64; only those of a block are kept."""

    def table(m: int) -> list[np.ndarray]:
        out = []
        for b in (_BASE, pow(_BASE, -1, 2**64)):
            p = np.full(m, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        return out

    if not _POWERS:
        _POWERS.extend(table(BLOCK + 1))
    up, down = _POWERS if n <= len(_POWERS[0]) else table(n)
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def factors(n: int) -> np.ndarray:
    """A pseudo-random factor for each of n places. Unlike powers of a base, they are no function of each other, so that no texts collide by their form."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x2545F4914F6CDD1D))


_FACTORS = factors(PLACES)


@dataclass
class Words:
    """The words of texts ``first`` .. ``first + len(bounds) - 2`` of a batch: text i has bounds[i] .. bounds[i + 1] of ``hashes``."""

    first: int
    bounds: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of strings, a null as an empty one."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def words_of(texts: pa.Array, lower: bool) -> Iterator[Words]:
    """The words of all texts, some texts (of BLOCK bytes, or one longer text) at a time. A null has no words."""
    if not len(texts):
        return
    offsets, data = buffers(texts)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, side="right")) - 1)
        to = min(to, n)
        base, end = int(offsets[at]), int(offsets[to])
        edge = offsets[at : to + 1] - base
        if end - base <= BLOCK:
            yield Words(at, *_words(data[base:end], edge, lower))
        else:
            parts = []
            while base < end:
                stop = _gap(data, base + BLOCK, end)
                parts.append(_words(data[base:stop], np.array([0, stop - base]), lower)[1])
                base = stop
            hashes = np.concatenate(parts)
            yield Words(at, np.array([0, *[len(hashes)] * (len(edge) - 1)]), hashes)
        at = to


def _gap(data: np.ndarray, at: int, end: int) -> int:
    """The first separator from ``at`` on, or ``end``."""
    step = 1 << 12
    while at < end:
        found = np.flatnonzero(_SPACE[data[at : min(end, at + step)]])
        if len(found):
            return at + int(found[0])
        at, step = at + step, 2 * step
    return end


def _words(buf: np.ndarray, edge: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes) of the words of some texts, which begin at the edges."""
    n = len(buf)
    if not n:
        return np.zeros(len(edge), np.int64), np.zeros(0, np.uint64)
    if lower:
        buf = _LOWER[buf]
    word = ~_SPACE[buf]
    cut = np.zeros(n + 1, dtype=bool)
    cut[edge] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | cut[1:n]
    stop = word
    stop[:-1] &= ~word[1:] | cut[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    # The sum of (byte + 1) * factor of its place in the word: universal hashing by random factors.
    size = ends - starts
    longest = int(size.max(initial=0))
    factor = _FACTORS if longest <= PLACES else factors(longest)
    place = np.ones(n, np.int32)
    place[:1] = 0
    place[starts] -= np.diff(starts, prepend=0).astype(np.int32)
    np.cumsum(place, out=place)  # the distance to where the last word began
    np.minimum(place, len(factor) - 1, out=place)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * factor[place], out=total[1:])
    hashes = mix(total[ends] - total[starts] + size.astype(np.uint64) * np.uint64(_BASE))
    return np.searchsorted(starts, edge), hashes


def grams(w: Words, k: int) -> np.ndarray:
    """The hash of the k words from each word on; where a text ends sooner, the value has no meaning."""
    if len(w.hashes) < k:
        return np.zeros(0, np.uint64)
    n, h = len(w.hashes) - k + 1, w.hashes
    if k <= len(_STEP):
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out += h[j : j + n] * _STEP[j]
        return mix(out)
    up, down = _powers(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[:n])


def shingle_sets(texts: pa.Array, lower: bool = True, k: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """(position in the batch, sorted distinct shingle hashes) of each text.

    A text of fewer than k words gives its whole sequence as one shingle; one without words gives none.
    """
    for w in words_of(texts, lower):
        g, b = grams(w, k), w.bounds
        for i in range(len(w)):
            s, e = int(b[i]), int(b[i + 1])
            if e - s >= k:
                x = g[s : e - k + 1].copy()
                x.sort()
                keep = np.empty(len(x), bool)
                keep[0] = True
                np.not_equal(x[1:], x[:-1], out=keep[1:])
                yield w.first + i, x[keep]
            elif e > s:
                short = np.cumsum(w.hashes[s:e] * _STEP[: e - s], dtype=np.uint64)[-1:]
                yield w.first + i, mix(short + np.uint64(0x51ED270B * (e - s)))
            else:
                yield w.first + i, np.zeros(0, np.uint64)
