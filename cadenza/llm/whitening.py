"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation (Golub and Kahan, 1965).

The entries become whole numbers x = floor(64 c) + 10**6, so that counts, sums and deviations are exact. A is the matrix of the
different x-vectors, centred before anything is multiplied. From a start vector v the process takes A v and A'u in turn,
each a pass of Spark over blocks of rows, and makes every new vector orthogonal to all before it, twice ("full
reorthogonalisation"). It ends after as many steps as there are dimensions, so that equal eigenvalues are all found; a
step that meets the null space or an invariant subspace goes on from a fresh direction. The singular
value decomposition of the small bidiagonal matrix gives the components and their deviations.

A left vector is as long as the table. It is kept as the coefficients y of u = A y, a vector of the dimension, and
made anew where a pass needs it: nothing of the table's length is stored between passes but the blocks themselves, and
nothing of that length comes to the driver. A pass brings it one vector of length dimension + step from each of at most FANIN tasks.

Cases: a null vector and one with null or non-finite entries are dropped; equal rows count once in the fit and each have their
rows in the result, null and repeated ids included. Vectors of different lengths are fitted each length on its own. An
empty vector, and a length with one different vector only, has no components and no rows. Components whose
eigenvalue is 0 to double precision are left out, so that there may be fewer than asked. An entry over 2**40 counts as 2**40, and
a deviation that fits no long is null. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.scratch import materialize, release

SCALE, SHIFT, FARTHEST = 64, 1_000_000, 2**40
#: Rows in a block, and partial sums that come to the driver in a pass.
BLOCK, FANIN = 4096, 16
EPS = np.finfo(float).eps

_X = "vec_id long, dim int, x binary"
_BLOCKS = "dim int, n int, x binary, sums array<long>"
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_numbers(embeddings: DataFrame) -> DataFrame:
    """vec_id, dim, x (int64 as bytes) of the rows whose vector has finite entries only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            flat = v.flatten()
            size = np.where(v.is_valid().to_numpy(zero_copy_only=False), v.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
            values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(float)
            bad = np.append(0, np.cumsum(~np.isfinite(values)))
            end = np.cumsum(size)
            keep = np.flatnonzero((size > 0) & (bad[end] == bad[end - size]))
            x = np.floor(SCALE * np.clip(np.nan_to_num(values), -FARTHEST, FARTHEST)).clip(-FARTHEST, FARTHEST).astype(np.int64) + SHIFT
            rows = [x[end[k] - size[k] : end[k]].tobytes() for k in keep.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array(size[keep], pa.int32()), pa.array(rows, pa.binary())], names=["vec_id", "dim", "x"])

    return embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, _X)


def blocks_of(rows: DataFrame) -> DataFrame:
    """The different x-vectors, BLOCK of them a row, with their number and sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vectors = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for d in np.unique(dims).tolist():
                own = [vectors[k] for k in np.flatnonzero(dims == d).tolist()]
                for at in range(0, len(own), BLOCK):
                    part = own[at : at + BLOCK]
                    data = b"".join(part)
                    sums = np.frombuffer(data, np.int64).reshape(-1, d).sum(0)
                    yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([len(part)], pa.int32()), pa.array([data], pa.binary()), pa.array([sums.tolist()], pa.list_(pa.int64()))], names=["dim", "n", "x", "sums"])

    return rows.select("dim", "x").distinct().mapInArrow(run, _BLOCKS)


def _from_mean(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: in 64 bits where they hold it, else in Python's whole numbers."""
    if float(np.abs(x).max(initial=0)) * n < 2.0**61:
        return n * x - sums
    return x.astype(object) * n - sums.astype(object)


@dataclass
class Table:
    """The centred matrix A of one length: blocks in Spark, the number of rows and the sums."""

    blocks: DataFrame
    dim: int
    n: int
    sums: np.ndarray

    def __post_init__(self) -> None:
        self.few = self.blocks.rdd.getNumPartitions() <= FANIN

    def total(self, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all blocks of ``part``, a vector made of a block's centred rows."""
        n, sums, dim = self.n, self.sums, self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            got = None
            for batch in batches:
                for data in batch.column(0):
                    a = (_from_mean(np.frombuffer(data.as_buffer(), np.int64).reshape(-1, dim), n, sums) / n).astype(float)
                    got = part(a) if got is None else got + part(a)
            if got is not None:
                yield pa.RecordBatch.from_arrays([pa.array([got.tolist()], pa.list_(pa.float64()))], names=["v"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = [np.array(v) for batch in batches for v in batch.column(0).to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([sum(rows).tolist()], pa.list_(pa.float64()))], names=["v"])

        parts = self.blocks.select("x").mapInArrow(run, "v array<double>")
        if not self.few:  # the tasks' sums are added up by a few tasks
            parts = parts.repartition(FANIN).mapInArrow(add, "v array<double>")
        return np.sum([np.array(r[0]) for r in parts.collect()], axis=0)

    def product(self, y: list[np.ndarray], new: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """Of u = A new: its products with the left vectors A y, its square, and A'u. One pass."""
        columns = np.column_stack([*y, new])

        def part(a: np.ndarray) -> np.ndarray:
            left = a @ columns
            u = left[:, -1]
            return np.concatenate([left.T @ u, a.T @ u])

        got = self.total(part)
        return got[: len(y)], float(got[len(y)]), got[len(y) + 1 :]


def _against(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """v made orthogonal to the basis, twice."""
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def bidiagonal(table: Table, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(B, V): A V = U B with B upper bidiagonal and V orthogonal; U = A Y is not kept."""
    rng = np.random.default_rng(seed)
    d = table.dim

    def fresh() -> np.ndarray:
        v = _against(rng.normal(size=d), right)
        return v / np.linalg.norm(v)

    right: list[np.ndarray] = []
    y: list[np.ndarray] = []
    alpha, beta = np.zeros(d), np.zeros(d)
    v, last, scale = fresh(), None, 0.0
    for j in range(d):
        right.append(v)
        new = v if last is None else v - beta[j - 1] * last
        for _ in range(2):
            h, square, back = table.product(y, new)
            for c, u in zip(h, y, strict=True):
                new = new - c * u
        # The second pass measured A new before its own small correction h.
        norm = float(np.sqrt(max(0.0, square - float(h @ h))))
        scale = max(scale, norm)
        if norm <= 64 * d * EPS * max(scale, float(np.max(np.abs(alpha), initial=0.0))):
            last = None
        else:
            alpha[j], last = norm, new / norm
            y.append(last)
            # A'u is known for the measured vector; where the correction counts at all, it is measured again.
            if float(np.abs(h).max(initial=0.0)) > 1e-14 * norm:
                back = table.product([], new)[2]
            v = _against(back / norm - norm * v, right)
            beta[j] = float(np.linalg.norm(v))
            scale = max(scale, beta[j])
        if last is None or beta[j] <= 64 * d * EPS * scale:
            beta[j], v = 0.0, fresh() if j + 1 < d else v
        else:
            v = v / beta[j]
    return np.diag(alpha) + np.diag(beta[:-1], 1), np.column_stack(right)


@dataclass
class Fit:
    """What whitens the vectors of one length: ``axes`` are the components over their deviations."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(table: Table, most: int) -> Fit | None:
    """The first ``most`` components of a table, None where it has none."""
    b, v = bidiagonal(table)
    _, s, q = np.linalg.svd(b)
    e = s**2 / table.n
    k = min(most, int((e > table.dim * EPS * e[0]).sum())) if e[0] > 0 else 0
    if not k:
        return None
    axes = (v @ q.T[:, :k]) / np.sqrt(e[:k])

    def part(a: np.ndarray) -> np.ndarray:
        z = a @ axes
        return np.concatenate([(z.T @ z).ravel(), z.sum(0), [np.sum(a * a)]])

    got = table.total(part) / table.n
    mean = got[k * k : k * k + k]
    error = np.abs(got[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max()
    return Fit(table.n, table.sums, axes, e[:k] / got[-1], float(error))


def whiten(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of each row and component."""
    rows = whole_numbers(embeddings)
    blocks = materialize(blocks_of(rows), "vector-blocks")
    sums = blocks.select("dim", F.posexplode("sums").alias("at", "s")).groupBy("dim", "at").agg(F.sum("s").alias("s"))
    counts = {r[0]: r[1] for r in blocks.groupBy("dim").agg(F.sum("n")).collect()}
    totals = {d: np.zeros(d, np.int64) for d in counts}
    for r in sums.collect():
        totals[r["dim"]][r["at"]] = r["s"]
    fits = {d: f for d, n in counts.items() if (f := fit(Table(blocks.where(F.col("dim") == d), d, n, totals[d]), components))}
    release(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for d, f in fits.items():
                own = np.flatnonzero(dims == d)
                for at in range(0, len(own), BLOCK):
                    rows, k = own[at : at + BLOCK], f.axes.shape[1]
                    far = _from_mean(np.frombuffer(b"".join(batch.column(2).take(pa.array(rows)).to_pylist()), np.int64).reshape(-1, d), f.n, f.sums)
                    if far.dtype == object or float(np.abs(far).max()) ** 2 * d >= 2.0**62:
                        squares = [sum(int(c) ** 2 for c in row) for row in far]
                        deviation = pa.array([s if s < 2**63 else None for s in squares], pa.int64())
                    else:
                        deviation = pa.array((far * far).sum(1))
                    each = np.repeat(np.arange(len(rows)), k)
                    same = lambda v: pa.array(np.full(len(each), v))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), same(np.int64(f.n)), deviation.take(pa.array(each)),
                            pa.array((((far / f.n).astype(float)) @ f.axes).ravel()), pa.array(np.tile(f.explained, len(rows))), same(f.identity_error),
                        ],
                        names=[c.split()[0] for c in _OUT.split(", ")],
                    )

    return rows.mapInArrow(run, _OUT)
