"""Sharding (operator 2): Karmarkar-Karp differencing over indivisible groups of equal texts.

Law ``bytes``: all rows of one text lie in one shard, and the shards' bytes are as equal as the
differencing makes them. A partial partition is a tuple of as many sums as there are shards; the two
with the largest spread are combined again and again, one turned round against the other, until one
is left.

Plan: equal texts become one group (a partial aggregation on a hash of the text, so a text that a third
of the rows have costs one row a task). The groups are dealt by their hash to cells of about CELL groups;
each task differences the groups of one cell and is left with one partial partition of 24 sums. Those
are differenced again, FAN at a time, level by level, until one is left: no task and no driver ever
sees more than a cell. Only ids, sizes and hashes are shuffled, never texts.

Row numbers in a shard come from counts of (shard, lane), where lanes cut each shard by a hash of the
row's id: no window covers a whole shard.

Cases: a null text has no bytes (size 8) and crc32 0 and is grouped with the empty ones. Ties and
repeated rows are ordinary; rows with the same doc_id and text are numbered apart. An empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.scratch import materialize

#: Groups that one task differences.
CELL = 20_000
#: Partial partitions that one task combines at a later level.
FAN = 512
#: Rows of a shard that one numbering window covers.
LANE = 20_000


def difference(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp over partial partitions.

    ``sums`` has a row for each partial partition and a column for each place. Returns (place: for each
    row and column, the final place that it went to; total: the sums of the final places, descending).
    """
    n, k = sums.shape
    order = np.argsort(-sums, axis=1, kind="stable")
    tops = np.take_along_axis(sums, order, axis=1)
    heap = [(-(int(t[0]) - int(t[-1])), i) for i, t in enumerate(tops)]
    heapq.heapify(heap)
    parts = list(tops)
    where: list[tuple[int, int, np.ndarray] | None] = [None] * n  # (left, right, how the merged places are ordered)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        merged = parts[a] + parts[b][::-1]
        turn = np.argsort(-merged, kind="stable")
        parts.append(merged[turn])
        where.append((a, b, turn))
        heapq.heappush(heap, (-(int(merged[turn[0]]) - int(merged[turn[-1]])), len(parts) - 1))
    root = heap[0][1]
    at: dict[int, np.ndarray] = {root: np.arange(k)}
    place = np.empty((n, k), np.int64)
    for i in range(len(parts) - 1, -1, -1):  # a part comes after the parts it is made of
        mine = at.pop(i)
        node = where[i]
        if node is None:
            place[i, order[i]] = mine
        else:
            a, b, turn = node
            before = np.empty(k, np.int64)
            before[turn] = mine
            at[a], at[b] = before, before[::-1]
    return place, parts[root]


def _cell(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # A single group is a partial partition with one place filled.
        pdf = pdf.sort_values(["bytes", "h"], ascending=[False, True], kind="stable")
        sums = np.zeros((len(pdf), k), np.int64)
        sums[:, 0] = pdf["bytes"].to_numpy()
        place, total = difference(sums)
        return pd.DataFrame({"h": pdf["h"].to_numpy(), "cell": pdf["cell"].to_numpy(), "place": place[:, 0].astype("int32"), "sums": [total[place[i, 0]] for i in range(len(pdf))]})

    return run


def _level(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cell", kind="stable")
        sums = np.stack([np.asarray(x, np.int64) for x in pdf["sums"]])
        place, total = difference(sums)
        n = len(pdf)
        return pd.DataFrame({"cell": np.repeat(pdf["cell"].to_numpy(), k), "up": np.repeat(pdf["up"].to_numpy(), k), "place": np.tile(np.arange(k, dtype="int32"), n), "to": place.reshape(-1).astype("int32"), "sum": total[place.reshape(-1)]})

    return run


def group_shards(groups: DataFrame, k: int) -> DataFrame:
    """(h, shard) for groups (h long, bytes long): Karmarkar-Karp in cells, then over the cells' partial partitions."""
    groups = materialize(groups, "groups")
    n = groups.count()
    cells = max(1, -(-n // CELL))
    placed = materialize(
        groups.withColumn("cell", F.pmod(F.xxhash64("h"), F.lit(cells))).groupBy("cell").applyInPandas(_cell(k), "h long, cell long, place int, sums long"), "cells"
    )
    state = placed.select("h", "cell", "place")
    sums = placed.groupBy("cell").agg(F.map_from_entries(F.collect_set(F.struct("place", "sums"))).alias("m")).select("cell", F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0))).alias("sums"))
    while cells > 1:
        up = -(-cells // FAN)
        moved = materialize(sums.withColumn("up", F.pmod(F.col("cell"), F.lit(up))).groupBy("up").applyInPandas(_level(k), "cell long, up long, place int, to int, sum long"), "level")
        state = state.join(moved, ["cell", "place"]).select("h", F.col("up").alias("cell"), F.col("to").alias("place"))
        sums = moved.groupBy("up").agg(F.map_from_entries(F.collect_set(F.struct("to", "sum"))).alias("m")).select(F.col("up").alias("cell"), F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0))).alias("sums"))
        cells = up
    return state.select("h", F.col("place").alias("shard"))


def number_rows(df: DataFrame, key: str, order: list[str], rows: int, name: str = "slot", lanes: Column | None = None) -> DataFrame:
    """A gapless number from 0 within each value of ``key``, without a window over all rows of a value.

    Lanes cut each value by a hash of the ``order`` columns; a row's number is the rows of the lanes
    before its own plus its rank in its lane. ``rows``: about how many rows there are, of which a lane over all values
    holds LANE; ``lanes``, where it is known how many rows each value has: its number of lanes.
    """
    df = df.withColumn("_lane", F.pmod(F.xxhash64(*order), F.lit(max(1, rows // LANE)) if lanes is None else lanes))
    counts = df.groupBy(key, "_lane").agg(F.count("*").alias("_n"))
    before = counts.select(key, "_lane", (F.sum("_n").over(Window.partitionBy(key).orderBy("_lane")) - F.col("_n")).alias("_before"))
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key, "_lane").orderBy(*order)))
    return ranked.join(before, [key, "_lane"]).withColumn(name, (F.col("_before") + F.col("_rank") - 1).cast("long")).drop("_lane", "_before", "_rank")


def shard_documents(documents: DataFrame, k: int = 24) -> DataFrame:
    """Each document's shard under the law ``bytes``: doc_id, size, text_crc32, shard, slot."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = materialize(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")),
        "sizes",
    )
    groups = rows.groupBy("h").agg(F.sum("size").alias("bytes"))
    placed = rows.join(group_shards(groups, k), "h")
    return number_rows(placed, "shard", ["doc_id", "h"], rows.count()).select("doc_id", "size", "text_crc32", "shard", "slot")
