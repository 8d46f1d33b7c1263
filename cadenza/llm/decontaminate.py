"""Benchmark decontamination (operator 10): short test items inside long documents.

Method: size-partitioned MinHash containment search, verified by exact shingle containment.
A document of n distinct five-word shingles falls in the size partition of 2**k bins, k the least
with n <= LOAD * 2**k. Its one-permutation MinHash keeps the least shingle hash of each bin (the
top k bits name the bin). An item is signed once for every partition, so both sides of a comparison
use the same bins however long the document is: a shared shingle survives in a document's bin with
probability of about (1 - exp(-LOAD)) / LOAD whatever its length, where a signature of fixed length
would lose short items in long documents. One equal bin makes a candidate; each candidate is then
decided by the exact share of the item's shingles in the document.

Items of fewer than FEW shingles have too few chances to meet in a bin. They are looked up in the document's
full set: an item of m shingles that shares s of them shares one of any m - s + 1, so these many of each
such item, for the least s that suffices, are the keys of one table. No such item can be missed.

Plan: one scan of the documents with two columns and no shuffle. The items' signatures are broadcast
in blocks of at most ITEM_BLOCK items and about ITEM_SHINGLES shingles; more items mean more blocks
over the same scan, not a larger broadcast (a single longer item is a block of its own).

Cases: null or empty texts, and texts without words, contain nothing and are contained in nothing.
A text of fewer than five words is one shingle, its whole sequence. Repeated rows give repeated
results; equal items each give their own. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.words import shingle_sets

#: Shingles a bin in the mean, at most.
LOAD = 1.0
#: Items of fewer shingles are looked up exactly. Others share 32 shingles or more at a threshold of 0.8, each in
#: its bin with a chance of over 0.57 (full load, and a fifth of the item's own in the way): missed under 1 in 10**11.
FEW = 40
MAX_BITS = 40
#: Items, and about shingles of items, in one broadcast: 4 MB, and as much again for each size partition that a worker meets.
ITEM_BLOCK, ITEM_SHINGLES = 20_000, 1 << 19
#: Items whose texts are on the driver at once, besides those of the partition that is being read.
ITEM_PART = 1000
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("n_item", T.LongType()),
        T.StructField("n_shared", T.LongType()),
        T.StructField("containment", T.DoubleType()),
    ]
)


def size_bits(n: int) -> int:
    """The size partition of a set of n shingles: the number of bins is 2**bits."""
    return min(MAX_BITS, max(0, int(np.ceil(np.log2(max(n, 1) / LOAD)))))


def minhash(sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
    """The least hash of each of 2**bits bins that has any (one permutation; the top bits are the bin)."""
    if not len(sorted_hashes) or not bits:
        return sorted_hashes[:1]
    bins = sorted_hashes >> np.uint64(64 - bits)
    keep = np.empty(len(bins), bool)
    keep[0] = True
    np.not_equal(bins[1:], bins[:-1], out=keep[1:])
    return sorted_hashes[keep]


def least_shared(n: int, threshold: float) -> int:
    """How many of an item's n shingles a document must have."""
    return int(np.ceil(threshold * n - 1e-9))


def _inverted(items: list[int], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values in order, start of each value's items, items)."""
    value = np.concatenate(values) if values else np.zeros(0, np.uint64)
    item = np.repeat(np.array(items, np.int64), [len(x) for x in values])
    order = np.argsort(value, kind="stable")
    keys, start = np.unique(value[order], return_index=True)
    return keys, np.append(start, len(order)), item[order]


def _met(table: tuple[np.ndarray, np.ndarray, np.ndarray], values: np.ndarray) -> set[int]:
    """The items in the table under any of the sorted values."""
    keys, start, items = table
    few, many = (keys, values) if len(keys) < len(values) else (values, keys)
    if not len(few):
        return set()
    at = np.searchsorted(many, few)
    same = many[np.minimum(at, len(many) - 1)] == few
    hit = np.flatnonzero(same) if few is keys else at[same]
    return {int(i) for a in hit for i in items[start[a] : start[a + 1]]}


class ItemIndex:
    """Signatures of a block of items for each size partition; built on the driver, broadcast."""

    def __init__(self, ids: list[int], sets: list[np.ndarray]):
        self.ids, self.sets = ids, sets
        self.long = [k for k, s in enumerate(sets) if len(s) >= FEW]
        self.short = [k for k, s in enumerate(sets) if len(s) < FEW]
        self._tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self._exact: dict[float, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def table(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct signature values in order, start of each value's items, items)."""
        if bits not in self._tables:
            self._tables[bits] = _inverted(self.long, [minhash(self.sets[k], bits) for k in self.long])
        return self._tables[bits]

    def exact(self, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of those shingles of the short items of which a document with enough of the item has one."""
        if threshold not in self._exact:
            sets = [self.sets[k] for k in self.short]
            self._exact[threshold] = _inverted(self.short, [s[: len(s) - max(1, least_shared(len(s), threshold)) + 1] for s in sets])
        return self._exact[threshold]

    def search(self, doc: np.ndarray, threshold: float) -> Iterator[tuple[int, int, int]]:
        """(item id, its shingles, shared shingles) for each item contained in a document's sorted set."""
        if not len(doc) or not self.ids:
            return
        found = set()
        if self.long:
            bits = size_bits(len(doc))
            found |= _met(self.table(bits), minhash(doc, bits))
        if self.short:
            found |= _met(self.exact(threshold), doc)
        for k in sorted(found):
            mine = self.sets[k]
            pos = np.searchsorted(doc, mine)
            shared = int((doc[np.minimum(pos, len(doc) - 1)] == mine).sum())
            if shared >= least_shared(len(mine), threshold):
                yield self.ids[k], len(mine), shared


def _indexes(spark: SparkSession, items: DataFrame) -> Iterator[Broadcast]:
    """An index for each block of items (at least one); items without an id or without words are in none."""
    rows = items.select("item_id", "text").toLocalIterator()
    ids, sets, size, some = [], [], 0, False
    while part := list(islice(rows, ITEM_PART)):
        for i, own in shingle_sets(pa.array([r["text"] for r in part], pa.string())):
            if len(own) and part[i]["item_id"] is not None:
                ids.append(int(part[i]["item_id"])), sets.append(own)
                size += len(own)
            if size >= ITEM_SHINGLES or len(ids) >= ITEM_BLOCK:
                yield spark.sparkContext.broadcast(ItemIndex(ids, sets))
                ids, sets, size, some = [], [], 0, True
    if ids or not some:
        yield spark.sparkContext.broadcast(ItemIndex(ids, sets))


def containments(documents: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Every (document, item) pair where the document has at least ``threshold`` of the item's shingles.

    ``documents`` needs doc_id and text, ``items`` item_id and text. One row a pair: doc_id, item_id,
    n_item (the item's distinct shingles), n_shared, containment. The items are the query set: they
    come to the driver a block at a time, the documents never do.
    """
    found: DataFrame | None = None
    for index in _indexes(documents.sparkSession, items):

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            own = index.value
            for batch in batches:
                ids, out = batch.column(0), []
                for i, doc in shingle_sets(batch.column(1)):
                    d = ids[i].as_py()
                    out += [(d, item, n, m, m / n) for item, n, m in own.search(doc, threshold)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=SCHEMA.names)

        part = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(search, SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found


def clean(documents: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The documents that contain no item, with all their columns; a null text contains none and stays."""
    for index in _indexes(documents.sparkSession, items):
        documents = documents.where(_free(index, threshold)(F.col("text").cast("string")))
    return documents


def _free(index: Broadcast, threshold: float):
    @F.pandas_udf("boolean")
    def free(texts: pd.Series) -> pd.Series:
        own = index.value
        sets = (doc for _, doc in shingle_sets(pa.array(texts, pa.string(), from_pandas=True)))
        return pd.Series([next(own.search(doc, threshold), None) is None for doc in sets], dtype=bool)

    return free
