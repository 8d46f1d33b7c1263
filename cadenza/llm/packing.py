"""Best-fit packing (operator 4): a configuration linear program over the length histogram.

Documents are encoded, ended with one end id and cut into pieces of at most ``limit`` tokens. What goes
to the driver is the histogram of piece lengths, at most ``limit`` counts whatever the corpus. In a task of its own the
covering program "choose how often to use each way to fill a sequence, so that every length is used as
often as it occurs, with the fewest sequences" is solved by multiplicative weights: each round prices
the lengths by their tokens, times a weight that falls with their coverage, and a bounded knapsack dynamic program over
the capacity gives the fillings of the highest price, one for each of the least covered lengths. Rounding takes the whole
parts, then the largest fractions that still fit, then solves the program for what is left. Best fit decreasing packs the
residue, under 1 % of the pieces on the tables at hand. The plan has some thousand fillings, whatever the corpus, and is
broadcast.

Each piece then finds its place by its length and its gapless number among the pieces of that length;
the numbering needs no window over all pieces of a length (``shards.number_rows``).

Cases: a null or empty text is one piece, the end id alone. A text of exactly ``limit`` - 1 tokens is one
full piece. Very long texts give many pieces. Repeated rows are packed each. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.scratch import materialize
from cadenza.llm.shards import number_rows
from cadenza.llm.token_counts import WordEncoder, frequent, in_worker

LIMIT = 4096
END = 1
#: Rounds of multiplicative weights; each prices the lengths once and takes COLUMNS fillings, for the lengths that are covered least.
ROUNDS, COLUMNS, STEP, RATE = 400, 512, 1.0, 0.1
#: The share of the tokens that the program may leave open, how often it is solved for what rounding leaves over, and the
#: tokens by which a filling may miss the fullest one with its longest piece.
EPSILON, AGAIN, SLACK = 0.05, 4, 4
#: Pieces of one length that one numbering window covers, about.
LANE = 2_000
PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def cut_documents(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32 (no ids; they can be encoded again)."""
    table = documents.sparkSession.sparkContext.broadcast(frequent(documents, WordEncoder, path))
    end = np.array([END], "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = in_worker(WordEncoder, path, table.value)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encoder.ids(batch.column(1))):
                ids = np.concatenate([ids, end])
                for k, at in enumerate(range(0, len(ids), limit)):
                    part = ids[at : at + limit]
                    row.append(i), piece.append(k), start.append(at), length.append(len(part)), crc.append(zlib.crc32(part))
            if row:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *(pa.array(x, t) for x, t in ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (crc, pa.int64())))], names=PIECES.names)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def priced(lengths: np.ndarray, most: np.ndarray, price: np.ndarray, capacity: int, rooms: np.ndarray) -> np.ndarray:
    """The fillings of the highest total price for each of the ``rooms``, a row each: how often each length is used, at most ``most`` times.

    A bounded knapsack: a length's allowed times are cut into powers of two and a rest, and each of these is used or not.
    """
    item, times = [], []
    for i, m in enumerate(np.minimum(most, capacity // lengths).tolist()):
        part = 1
        while m > 0:
            item.append(i), times.append(min(part, m))
            m, part = m - part, 2 * part
    size = np.array(times) * lengths[item]
    value = np.array(times) * price[item]
    # Whether an item is used, a bit for each room.
    best, took = np.zeros(capacity + 1), np.zeros((len(item), capacity // 8 + 1), np.uint8)
    for k, (s, v) in enumerate(zip(size.tolist(), value.tolist(), strict=True)):
        sums, row = best[: capacity + 1 - s] + v, np.zeros(capacity + 1, bool)
        np.greater(sums, best[s:] + 1e-9, out=row[s:])
        took[k] = np.packbits(row, bitorder="little")
        np.maximum(best[s:], sums, out=best[s:])
    left, out = rooms.copy(), np.zeros((len(rooms), len(lengths)), np.int64)
    for k in range(len(item) - 1, -1, -1):
        used = (took[k, left >> 3] >> (left & 7) & 1).astype(bool)
        if used.any():
            out[used, item[k]] += times[k]
            left[used] -= size[k]
    return out


def _key(lengths: np.ndarray, times: np.ndarray) -> bytes:
    """A filling in few bytes: its lengths, then how often it has each."""
    return np.concatenate([lengths, times]).astype("<u4").tobytes()


def _filling(key: bytes) -> dict[int, int]:
    both = np.frombuffer(key, "<u4").reshape(2, -1).tolist()
    return dict(zip(*both, strict=True))


def cover(lengths: np.ndarray, n: np.ndarray, limit: int) -> dict[bytes, float]:
    """The linear program by multiplicative weights: how often each filling is used, so that at most ``n`` pieces of each length are.

    It ends when all but EPSILON of the tokens are covered, or when a round adds nothing. A filling is used for the share STEP of
    what is left of its scarcest length, and for a whole sequence if there is that much.
    """
    used: dict[bytes, float] = {}
    covered = np.zeros(len(n))
    tokens = float(lengths @ n)
    for _ in range(ROUNDS):
        free = n - covered
        some = np.flatnonzero(free > 1e-6)
        if lengths[some] @ free[some] <= EPSILON * tokens:
            break
        own = lengths[some]
        share = covered[some] / n[some]
        price = own * np.exp(-RATE * share)
        first = np.lexsort((-own, share))[:COLUMNS]
        columns = priced(own, np.ceil(free[some]).astype(np.int64), price, limit, limit - own[first])
        columns[np.arange(len(first)), first] += 1
        added = False
        for column in columns:
            k = np.flatnonzero(column)
            room = float((free[some[k]] / column[k]).min())
            if room <= 1e-6:
                continue
            add = max(min(room, 1.0), STEP * room)
            key = _key(own[k], column[k])
            used[key] = used.get(key, 0.0) + add
            free[some[k]] -= add * column[k]
            covered[some[k]] += add * column[k]
            added = True
        if not added:
            break
    return used


def reach(lengths: np.ndarray, n: np.ndarray, limit: int) -> np.ndarray:
    """For each room up to ``limit`` the most tokens that pieces of these lengths can fill of it, each used at most as often as there are pieces."""
    bits, mask = 1, (1 << limit + 1) - 1
    for length, m in zip(lengths.tolist(), np.minimum(n, limit // lengths).tolist()):
        part = 1
        while m > 0:
            bits |= bits << min(part, m) * length & mask
            m, part = m - part, 2 * part
    can = np.frombuffer(bits.to_bytes(limit // 8 + 1, "little"), np.uint8)
    return np.maximum.accumulate(np.where(np.unpackbits(can, bitorder="little")[: limit + 1], np.arange(limit + 1), 0))


def fillings(histogram: dict[int, int], limit: int = LIMIT) -> tuple[list[tuple[int, dict[int, int]]], int]:
    """((times, {length: pieces}), so that every piece is used exactly once and no filling is over ``limit``; how many of these the program gave)."""
    left = np.zeros(limit + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    plan: list[tuple[int, dict[int, int]]] = []
    if left[limit]:
        plan.append((int(left[limit]), {limit: 1}))
        left[limit] = 0
    # What rounding leaves over is a smaller program of the same kind.
    for _ in range(AGAIN):
        lengths = np.flatnonzero(left)
        if not len(lengths):
            break
        used = cover(lengths, left[lengths].astype(float), limit)
        before, full = len(plan), reach(lengths, left[lengths], limit)
        for up in (0, 1):  # whole parts first, then what is left of the largest fractions
            for key, x in sorted(used.items(), key=lambda kv: (-(kv[1] if up == 0 else kv[1] % 1), kv[0])):
                most = int(x + 1e-6) if up == 0 else int(x % 1 > 1e-6 and x % 1 < 1 - 1e-6)
                if not most:
                    continue
                filling = _filling(key)
                times, longest = min(most, *(int(left[k] // v) for k, v in filling.items())), max(filling)
                if times > 0 and sum(k * v for k, v in filling.items()) >= longest + full[limit - longest] - SLACK:
                    plan.append((times, filling))
                    for k, v in filling.items():
                        left[k] -= times * v
        if len(plan) == before:
            break
    given = len(plan)
    return plan + best_fit(left, limit), given


def best_fit(left: np.ndarray, limit: int) -> list[tuple[int, dict[int, int]]]:
    """Best fit decreasing on a histogram: the longest piece, then whatever fills the rest best (a subset sum over what is left)."""
    left, plan = left.copy(), []
    while len(some := np.flatnonzero(left)):
        longest = int(some[-1])
        filling, room = {longest: 1}, limit - longest
        while room > 0:
            fits = some[: np.searchsorted(some, room, side="right")]
            fits = fits[left[fits] > [filling.get(int(f), 0) for f in fits]] if len(fits) else fits
            if not len(fits):
                break
            pick = int(fits[-1])
            # Two pieces that fill the room to the last token are better than the longest one.
            if pick != room and len(pair := np.intersect1d(fits, room - fits)):
                a = int(pair[-1])
                if a != room - a or left[a] - filling.get(a, 0) >= 2:
                    pick = a
            filling[pick] = filling.get(pick, 0) + 1
            room -= pick
        times = int(min(left[k] // v for k, v in filling.items()))
        plan.append((times, filling))
        for k, v in filling.items():
            left[k] -= times * v
    return plan


def places(plan: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """The plan as arrays sorted by (length, first number): which numbers of a length go to which sequences and offsets."""
    rows, sequence, taken = [], 0, {}
    for times, filling in plan:
        offset = 0
        for length, per in sorted(filling.items(), reverse=True):
            first = taken.get(length, 0)
            rows.append((length, first, sequence, per, offset))
            taken[length] = first + times * per
            offset += length * per
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "sequence", "per", "offset"), cols, strict=True))


def planned(spark: SparkSession, histogram: dict[int, int], limit: int = LIMIT) -> dict[str, np.ndarray]:
    """The places of the histogram's fillings. A task solves the program, so that the driver holds the plan alone."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {k: n for batch in batches for k, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)}
        yield pa.RecordBatch.from_pydict(places(fillings(counts, limit)[0]))

    counts = spark.createDataFrame(list(histogram.items()), "length long, n long").coalesce(1)
    plan = counts.mapInArrow(solve, "length long, first long, sequence long, per long, offset long").toArrow()
    return {c: plan[c].to_numpy() for c in plan.column_names}


def pack_documents(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Every piece's place: the columns of PIECES, sequence_id and offset."""
    spark = documents.sparkSession
    pieces = materialize(cut_documents(documents, path, limit), "pieces")
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(planned(spark, histogram, limit))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        p = plan.value
        wide = np.int64(1 << 48)
        n = number.to_numpy(np.int64)
        i = np.searchsorted(p["length"] * wide + p["first"], length.to_numpy(np.int64) * wide + n, side="right") - 1
        k = n - p["first"][i]
        return pd.DataFrame({"sequence_id": p["sequence"][i] + k // p["per"][i], "offset": p["offset"][i] + (k % p["per"][i]) * p["length"][i]})

    lanes = spark.createDataFrame([(k, -(-n // LANE)) for k, n in histogram.items()], "length long, _lanes long")  # at most ``limit`` rows
    numbered = number_rows(pieces.join(F.broadcast(lanes), "length"), "length", ["doc_id", "piece", "ids_crc32"], 0, "_number", F.col("_lanes"))
    return numbered.withColumn("_at", place("length", "_number")).select(*PIECES.names, "_at.sequence_id", "_at.offset")
