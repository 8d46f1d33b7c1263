"""Embedding near-dedup (operator 6): cross-polytope hashing after fast Hadamard rotations.

A vector is turned by three rounds of random signs and a fast Walsh-Hadamard transform; its hash is the
nearest signed axis. Some such hashes (``depth``) make a bucket of one of several tables (``tables``). With multiprobe a vector also
enters the bucket that differs in the hash it was least sure of; a pair is a candidate where at least one
of the two is in its own bucket. Every candidate's cosine is computed in double precision.

Plan:
1. Equal vectors become one node with a weight (a partial aggregation), so copies cost one row a task. Vectors of
   different lengths never meet; each length has its own depth and number of tables.
2. Each node sends a sketch of itself (4 bits a component, and how far that is from the vector) to its buckets, PROBES in
   each table. Sketches rule out, without error, nearly all unlike vectors that share a bucket by chance.
3. Nodes that may have a neighbour in a bucket send their vector there. A pair that shares several buckets is
   counted in the first of them only - both nodes carry all their buckets - so pairs are neither
   written nor sorted; what leaves a group is a count a node and one link a node, to the smallest node it is joined to there.
A bucket of more than BLOCK nodes is dealt to blocks and each pair of blocks is compared on its own: no comparison holds
more than 2 * BLOCK vectors and no pair is left out. A task takes many small buckets or some pairs of blocks.

The depth follows the number of different vectors, so that a bucket of unlike vectors keeps about the same size,
and the number of tables follows the depth: a pair at exactly the threshold is in no common bucket with a chance
of at most MISS, whatever the size of the table; closer pairs are missed less.

Cases: null vectors, zero vectors, and vectors with null or non-finite components link with nothing. Copies link with each
other. Rows with the same vec_id are returned each. Rows with a null vec_id are compared like others; a component of
such rows alone has a null id (ids of 2**62 and more are kept free for them). An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.graph import components
from cadenza.llm.scratch import materialize

#: Tables at least, and the least length of a vector that is rotated.
TABLES, PROBES, LEAST = 4, 2, 64
#: The chance to miss a pair at the threshold, at most, and the pairs that are drawn to know a table's share of it.
MISS, DRAWN = 0.01, 8192
#: Vectors of a bucket that one side of a group holds.
BLOCK = 1024
#: Pairs whose buckets are compared at once.
PAIRS = 1 << 16
#: Cosines that are held at once, and rows that one task compares (it takes whole buckets or pairs of blocks).
CELLS, ROWS = 1 << 21, 8192
SEED = 7
#: Ids of nodes without a vec_id begin here.
NAMELESS = 1 << 62
BUCKET = ["dim", "table", "code"]
SENT = "dim int, table int, code long, node long, probe boolean, sketch binary"


def padded(dim: int) -> int:
    """The length that vectors are filled up to with zeros: a power of 2, at least LEAST, as few signs make few rotations."""
    return max(LEAST, 1 << max(1, (dim - 1).bit_length()))


def depth(n: int, dim: int) -> int:
    """Hashes a bucket: enough that n unlike vectors leave about 32 in one of a table's buckets."""
    return max(1, math.ceil(math.log(max(n, 2) / 32) / math.log(2 * padded(dim))))


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the row length is a power of 2."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def _codes(images: Iterator[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The code of the own bucket of each row and of the second one, from the row's image under each of a table's rotations."""
    first, second, sure = [], [], []
    for y in images:
        rows, size = np.arange(len(y)), np.abs(y)
        top = np.argpartition(-size, 1, axis=1)[:, :2]
        swap = size[rows, top[:, 0]] < size[rows, top[:, 1]]
        top[swap] = top[swap][:, ::-1]
        a, b = top[:, 0], top[:, 1]
        first.append(2 * a + (y[rows, a] < 0))
        second.append(2 * b + (y[rows, b] < 0))
        sure.append(size[rows, a] - size[rows, b])
    weakest = np.argmin(np.stack(sure, 1), axis=1)
    own = probe = np.zeros(len(weakest), np.int64)
    for j in range(len(first)):
        own = own * (2 * n) + first[j]
        probe = probe * (2 * n) + np.where(weakest == j, second[j], first[j])
    return own, probe


def tables(k: int, dim: int, threshold: float) -> int:
    """Tables of depth k that leave a pair at the threshold without a common bucket with a chance of at most MISS.

    A table's chance to have the pair is the share of DRAWN random pairs, less three standard errors."""
    rng = np.random.default_rng(SEED)
    n = padded(dim)
    met = 0
    step = max(1, min(DRAWN, (1 << 20) // n))
    for at in range(0, DRAWN, step):
        x, z = rng.normal(size=(2, min(step, DRAWN - at), k, n))
        x /= np.linalg.norm(x, axis=2, keepdims=True)
        z -= (x * z).sum(2, keepdims=True) * x
        z /= np.linalg.norm(z, axis=2, keepdims=True)
        near = threshold * x + math.sqrt(max(0.0, 1 - threshold * threshold)) * z
        (a, b), (c, d) = (_codes((v[:, j] for j in range(k)), n) for v in (x, near))
        met += int(((a == c) | (a == d) | (b == c)).sum())
    p = max(met, 1) / DRAWN
    p = max(p - 3 * math.sqrt(p * (1 - p) / DRAWN), p / 2)
    return TABLES if p >= 1 else max(TABLES, math.ceil(math.log(MISS) / math.log1p(-p)))


def buckets(x: np.ndarray, k: int, count: int = TABLES) -> tuple[np.ndarray, np.ndarray]:
    """(own, probe): each (rows, count), the code of the own bucket and of the second one in each table."""
    rng = np.random.default_rng(SEED)
    n = padded(x.shape[1])
    filled = np.zeros((len(x), n))
    filled[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    own, probe = np.empty((len(x), count), np.int64), np.empty((len(x), count), np.int64)

    def images() -> Iterator[np.ndarray]:
        for _ in range(k):
            y = filled
            for _ in range(3):
                y = _hadamard(y * rng.choice([-1.0, 1.0], n))
            yield y

    for t in range(count):
        own[:, t], probe[:, t] = _codes(images(), n)
    return own, probe


def sketches(x: np.ndarray) -> list[bytes]:
    """Of each unit vector: the step, the length of what the sketch leaves out (both 32 bits, the latter rounded up), and 4 bits a component."""
    step = np.maximum(np.abs(x).max(1) / 7, 1e-30).astype(np.float32)
    q = np.rint(x / step[:, None].astype(np.float64)).clip(-8, 7)
    out = np.sqrt(((x - q * step[:, None].astype(np.float64)) ** 2).sum(1)) * (1 + 1e-6) + 1e-7
    q = (q + 8).astype(np.uint8)
    if q.shape[1] % 2:
        q = np.c_[q, np.full(len(q), 8, np.uint8)]
    packed = q[:, 0::2] << 4 | q[:, 1::2]
    head = np.stack([step, out.astype(np.float32)], 1)
    return [h.tobytes() + p.tobytes() for h, p in zip(head, packed, strict=True)]


def unsketch(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(the vectors sketched, the lengths left out)."""
    raw = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
    head = np.ascontiguousarray(raw[:, :8]).view(np.float32)
    q = np.stack([raw[:, 8:] >> 4, raw[:, 8:] & 15], 2).reshape(len(raw), -1).astype(np.float32) - 8
    return q * head[:, :1], head[:, 1].astype(np.float64)


def _units(vectors: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    x = np.asarray(vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(rows), dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hashed(shapes: dict[int, tuple[int, int]], packed: bool):
    """Rows of SENT for each bucket of each node (node, dim, v); or, ``packed``, a row for each node with all its codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x, (k, count) = _units(batch.column(2), rows, int(dim)), shapes[int(dim)]
                own, probe = buckets(x, k, count)
                nodes = batch.column(0).take(pa.array(rows))
                if packed:
                    codes = [r.tobytes() for r in np.concatenate([own, probe], axis=1).astype(_width(k, int(dim)))]
                    yield pa.RecordBatch.from_arrays([nodes, pa.array(codes, pa.binary())], names=["node", "codes"])
                    continue
                sketch = pa.array(sketches(x), pa.binary())
                for t in range(count):
                    for p, code in ((False, own[:, t]), (True, probe[:, t])):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(x), dim, np.int32)), pa.array(np.full(len(x), t, np.int32)), pa.array(code), nodes, pa.array(np.full(len(x), p)), sketch], names=["dim", "table", "code", "node", "probe", "sketch"]
                        )

    return run


def _width(k: int, dim: int) -> type:
    """The least whole number type that holds a code of depth k."""
    size = (2 * padded(dim)) ** k
    return np.uint8 if size <= 1 << 8 else np.uint16 if size <= 1 << 16 else np.uint32 if size <= 1 << 32 else np.int64


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of rows of codes (own | probe), table * 3 + way of the first bucket in which they are candidates."""
    count = a.shape[1] // 2
    found = np.full(len(a), 3 * count, np.int64)
    for t in range(count - 1, -1, -1):
        oa, pa_, ob, pb = a[:, t], a[:, count + t], b[:, t], b[:, count + t]
        for way, same in ((2, pa_ == ob), (1, oa == pb), (0, oa == ob)):
            found[same] = 3 * t + way
    return found


def _join(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Union of the sets of u[k] and v[k] for all k; ``root`` gives each place's smallest known place and is kept flat."""
    while len(u):
        a, b = root[u], root[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (flat := root[root] != root).any():
            root[flat] = root[root[flat]]


def _alike(pdf: pd.DataFrame, close) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one bucket (and pair of blocks) that are close; rows are in order of bucket and side.

    ``close`` takes the places of two sets of rows (or of many such sets of equal size) and says which pairs are."""
    keys = pdf[["table", "code", "i", "j"]].to_numpy()
    begin = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
    size = np.diff(np.r_[begin, len(pdf)])
    two = keys[begin, 2] != keys[begin, 3]
    for n in np.unique(size[~two]):
        if n < 2:
            continue
        starts = begin[~two & (size == n)]
        step = max(1, CELLS // int(n * n))
        for at in range(0, len(starts), step):
            rows = starts[at : at + step, None] + np.arange(n)
            k, i, j = np.nonzero(close(rows, rows))
            less = i < j
            yield rows[k[less], i[less]], rows[k[less], j[less]]
    side = pdf["side"].to_numpy()
    for s, n in zip(begin[two], size[two], strict=True):
        cut = s + int((side[s : s + n] == 0).sum())
        step = max(1, CELLS // max(1, int(s + n - cut)))
        for at in range(s, cut, step):
            i, j = np.nonzero(close(np.arange(at, min(cut, at + step)), np.arange(cut, s + n)))
            yield i + at, j + cut


def _by_length(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for _, own in pdf.groupby("dim", sort=True):
        yield own.sort_values(["table", "code", "i", "j", "side", "node", "probe"], kind="stable", ignore_index=True)


def _possible(threshold: float):
    """The rows of buckets that may have a neighbour there, by sketch."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for own in _by_length(pdf):
            q, error = unsketch(own["sketch"].tolist())
            size = np.sqrt((q.astype(np.float64) ** 2).sum(1))
            node, probe, may = own["node"].to_numpy(), own["probe"].to_numpy(), np.zeros(len(own), bool)

            def close(a: np.ndarray, b: np.ndarray, q=q, error=error, size=size) -> np.ndarray:
                bound = (size[a] + error[a])[..., :, None] * error[b][..., None, :] + error[a][..., :, None] * size[b][..., None, :]
                return np.matmul(q[a], np.swapaxes(q[b], -1, -2)) + bound >= threshold - 1e-4

            for i, j in _alike(own, close):
                ok = ~(probe[i] & probe[j]) & (node[i] != node[j])
                may[i[ok]] = may[j[ok]] = True
            out.append(own.loc[may, [*BUCKET, "node", "probe"]])
        return pd.concat(out)

    return run


def _linked(threshold: float, shapes: dict[int, tuple[int, int]]):
    """The links of each node that are counted in these buckets, and the smallest node it is joined to here."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for own in _by_length(pdf):
            dim = int(own["dim"].iloc[0])
            x = np.stack(own["v"].to_numpy()).astype(np.float64)
            x /= np.sqrt((x * x).sum(1))[:, None]
            codes = np.frombuffer(b"".join(own["codes"]), _width(shapes[dim][0], dim)).reshape(len(own), -1)
            node, weight, probe, table = (own[c].to_numpy() for c in ("node", "weight", "probe", "table"))
            ids, place = np.unique(node, return_inverse=True)
            links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
            for found in _alike(own, lambda a, b, x=x: np.matmul(x[a], np.swapaxes(x[b], -1, -2)) >= threshold):
                for cut in range(0, len(found[0]), PAIRS):
                    i, j = found[0][cut : cut + PAIRS], found[1][cut : cut + PAIRS]
                    ok = ~(probe[i] & probe[j]) & (node[i] != node[j])
                    i, j = i[ok], j[ok]
                    i, j = np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)
                    # The pair is counted here if this is the first bucket that makes it a candidate, in this very way.
                    here = _first_shared(codes[i], codes[j]) == 3 * table[i] + np.where(probe[i], 2, np.where(probe[j], 1, 0))
                    i, j = i[here], j[here]
                    np.add.at(links, place[i], weight[j])
                    np.add.at(links, place[j], weight[i])
                    _join(root, place[i], place[j])
            some = links > 0
            out.append(pd.DataFrame({"node": ids[some], "links": links[some], "to": ids[root[some]]}))
        return pd.concat(out)

    return run


def _dealt(sent: DataFrame, held: int) -> DataFrame:
    """Rows of buckets with two nodes or more, each with its block for every pair of blocks that has it, and the task that compares them.

    Block i is the first side of (i, j >= i) and the second of (j < i, i). ``held``: rows of all buckets, about.
    """
    sizes = sent.groupBy(*BUCKET).agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("long"))
    parts = max(1, held // ROWS)
    dealt = sent.join(sizes, BUCKET).withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other"), "side": F.when(F.col("block") <= F.col("other"), 0).otherwise(1)}).drop("n", "block", "blocks", "other")
    return dealt.withColumn("part", F.pmod(F.xxhash64(*BUCKET, "i", "j"), F.lit(parts)))


def _rows(sent: DataFrame) -> int:
    """How many rows _dealt makes: a bucket of b blocks sends each of its rows b times."""
    sizes = sent.groupBy(*BUCKET).agg(F.count("*").alias("n")).where("n > 1")
    return sizes.agg(F.coalesce(F.sum(F.col("n") * F.ceil(F.col("n") / BLOCK)), F.lit(0)).cast("long").alias("n")).first()["n"]


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links and component_id of every vector; ``vectors`` has vec_id and embedding (an array of numbers)."""
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    sound = F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists("v", lambda c: c != 0)
    rows = materialize(rows.withColumn("h", F.when(F.coalesce(sound, F.lit(False)), F.sha2(F.to_json(F.transform("v", lambda c: c + F.lit(0.0))).cast("binary"), 256))).withColumn("dim", F.size("v")), "vectors")
    nameless = F.shiftrightunsigned(F.xxhash64("h"), 2) + F.lit(NAMELESS)
    nodes = rows.where("h is not null").groupBy("h").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("dim").alias("dim"), F.first("v").alias("v"))
    nodes = materialize(nodes.withColumn("node", F.coalesce("node", nameless)), "nodes")
    # One row for each length of vectors.
    shapes = {}
    for r in nodes.groupBy("dim").count().collect():
        k = depth(r["count"], r["dim"])
        shapes[r["dim"]] = k, tables(k, r["dim"], threshold) if r["count"] > 1 else TABLES
    if not shapes:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    plain = nodes.select("node", "dim", "v")
    sent = materialize(plain.mapInArrow(_hashed(shapes, False), SENT), "sketches")
    near = _dealt(sent, _rows(sent)).groupBy("part").applyInPandas(_possible(threshold), "dim int, table int, code long, node long, probe boolean")
    near = materialize(near.distinct(), "near")
    packed = materialize(plain.join(near.select("node").distinct(), "node", "left_semi").select("node", "dim", "v").mapInArrow(_hashed(shapes, True), "node long, codes binary"), "codes")
    full = nodes.select("node", "weight", "v").join(packed, "node")
    dealt = _dealt(near, _rows(near)).join(full, "node")
    found = materialize(dealt.groupBy("part").applyInPandas(_linked(threshold, shapes), "node long, links long, to long"), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    out = rows.join(nodes.select("h", "node", "weight"), "h", "left").join(counts, "node", "left").join(roots.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left")
    root = F.coalesce("root", "node", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("links") + F.col("weight") - 1, F.col("weight") - 1, F.lit(0)).cast("long").alias("n_links"), F.when(root < NAMELESS, root).alias("component_id"))
