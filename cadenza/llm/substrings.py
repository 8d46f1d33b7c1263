"""Substring dedup (operator 5): Rabin-Karp hashes of every window of 50 words, counted in Spark.

Each word is removed that lies in a window whose words also start in a document with a smaller id; all
windows are judged on the input. Repeated windows merge into maximal removal intervals.

Plan:
1. Count. A scan hashes all windows of each document by a rolling sum (Rabin-Karp). A window's route is the least hash
   of its 25-word parts: equal windows have equal routes, and consecutive windows mostly share one, so that a run of
   about 13 windows counts as one (route, least and greatest document), once for each route of a block of WINDOWS windows.
   Spark sums them up; only windows on routes of two documents or more can repeat. These routes go into a bitmap of
   bounded size (``bloom``), which is broadcast.
2. Find. A second scan sends on the windows whose routes the bitmap has. Equal windows within one block are settled
   there: only the copy in the block's smallest document goes on, the others are removed whatever else there is. So a
   passage that a third of all documents share is sent once a block. What goes on is shuffled by route, a run a row
   (6 bytes a window; a window is known by its route and these 48 bits, 112 bits in all). Windows on routes of
   more than COMMON blocks (a bitmap again) are shuffled by their own hashes. A task reads its rows in order of route
   and finds the smallest document of each window, holding about WINDOWS at a time: within a route of more than that
   it settles what it holds, as a block does, and goes on with the copies in the smallest documents.
3. Merge. The repeated windows of each document become maximal intervals.
4. The intervals join the texts by id; documents that the bitmap of the ids concerned rules out aren't joined. The words
   that no interval covers are kept.

Cases: null texts have no words. Texts of fewer than 50 words have no window and lose nothing. Windows that
repeat within one document only are kept. Rows with the same doc_id are one document as to windows, and each
row is returned. Rows with a null doc_id aren't compared and lose nothing. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import bloom
from cadenza.llm.scratch import materialize
from cadenza.llm.words import grams, mix, words_of

WINDOW, PART = 50, 25
#: Windows that are compared at once, and texts that are words at once.
WINDOWS, ROWS = 1 << 19, 500
BYTES = 6
#: A route of more blocks than this is common: its windows go their own ways. A route that is not brings some 13 windows of each block at most to one task.
COMMON = 1 << 15
RUNS = "route long, doc long, start int, stop int, hashes binary"
_NAMES = ["route", "doc", "start", "stop", "hashes"]


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def _repeats(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each window, whether a smaller document has it too."""
    order = np.argsort(doc, kind="stable") if len(doc) and (doc[1:] < doc[:-1]).any() else None
    if order is not None:
        key, doc = key[order], doc[order]
    by = np.argsort(key, kind="stable")
    k, d = key[by], doc[by]
    first = np.empty(len(k), bool)
    first[:1] = True
    np.not_equal(k[1:], k[:-1], out=first[1:])
    out = np.empty(len(k), bool)
    out[by] = d > d[first][np.cumsum(first) - 1]
    if order is not None:
        back = np.empty(len(k), bool)
        back[order] = out
        return back
    return out


def _runs(doc: np.ndarray, pos: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of consecutive windows of one document begin and end (in the arrays); ``same`` must not change in a run."""
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.empty(len(doc), bool)
    new[0] = True
    new[1:] = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1)
    for x in same:
        new[1:] |= x[1:] != x[:-1]
    begin = np.flatnonzero(new)
    return begin, np.append(begin[1:], len(doc))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, route, doc, position) of windows, about WINDOWS at a time."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for w in words_of(batch.column(1), lower=False):
            n = np.diff(w.bounds)
            if not (n >= WINDOW).any():
                continue
            at = np.repeat(np.arange(len(w)), n)
            pos = np.arange(len(w.hashes)) - w.bounds[at]
            valid = np.flatnonzero(pos + WINDOW <= n[at])
            key, least = grams(w, WINDOW), _least(grams(w, PART), WINDOW - PART + 1)
            held.append((key[valid], mix(least[valid]), ids[w.first + at[valid]], pos[valid]))
            size += len(valid)
            if size >= WINDOWS:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least and the greatest document of each route of a block."""
    for _, route, doc, _ in _blocks(batches):
        first = np.append(True, (route[1:] != route[:-1]) | (doc[1:] != doc[:-1]))
        route, doc = route[first], doc[first]
        order = np.argsort(route, kind="stable")
        route, doc = route[order], doc[order]
        begin = np.flatnonzero(np.append(True, route[1:] != route[:-1]))
        yield pa.RecordBatch.from_arrays([pa.array(route[begin].view(np.int64)), pa.array(np.minimum.reduceat(doc, begin)), pa.array(np.maximum.reduceat(doc, begin))], names=["route", "lo", "hi"])


def _intervals(doc: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """Rows that remove the words of consecutive repeated windows; they pass through the next step."""
    begin, end = _runs(doc, pos)
    route = mix(doc[begin].astype(np.uint64)).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(route, pa.int64()), pa.array(doc[begin], pa.int64()), pa.array(pos[begin].astype(np.int32)), pa.array((pos[end - 1] + WINDOW).astype(np.int32)), pa.nulls(len(begin), pa.binary())], names=_NAMES)


def _sent(route: np.ndarray, doc: np.ndarray, pos: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    begin, end = _runs(doc, pos, route)
    data = np.ascontiguousarray(key.view(np.uint8).reshape(-1, 8)[:, :BYTES])
    offsets = np.append(begin, len(doc)).astype(np.int32) * BYTES
    hashes = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(route[begin].view(np.int64)), pa.array(doc[begin]), pa.array(pos[begin].astype(np.int32)), pa.nulls(len(begin), pa.int32()), hashes], names=_NAMES)


def _windows(shared, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows on shared routes, and runs of words that are removed already."""
        for key, route, doc, pos in _blocks(batches):
            gone = _repeats(key, doc)
            if gone.any():
                yield _intervals(doc[gone], pos[gone])
            kept = ~gone & bloom.within(shared.value, route)
            key, route, doc, pos = key[kept], route[kept], doc[kept], pos[kept]
            apart = bloom.within(common.value, route)
            route[apart] = mix(key[apart] + np.uint64(1000))
            yield _sent(route, doc, pos, key)

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals of words to remove, from rows in order of route."""
    held: list[tuple] = []
    size, last, full = 0, None, 2 * WINDOWS

    def found() -> Iterator[pa.RecordBatch]:
        """What is removed of the windows held; those that stay are held on."""
        nonlocal held
        key, doc, pos = (np.concatenate(x) for x in zip(*held, strict=True))
        gone = _repeats(key, doc)
        held = [tuple(x[~gone] for x in (key, doc, pos))]
        if gone.any():
            doc, pos = doc[gone], pos[gone]
            order = np.lexsort((pos, doc))
            yield _intervals(doc[order], pos[order]).select(["doc", "start", "stop"])

    for batch in batches:
        ready = batch.column(4).is_null()
        if ready.true_count:
            yield batch.filter(ready).select(["doc", "start", "stop"])
        rows = batch.filter(pc.invert(ready))
        if not len(rows):
            continue
        route = rows.column(0).to_numpy().view(np.uint64)
        if size >= WINDOWS and route[0] != last:
            yield from found()
            held, size, full = [], 0, 2 * WINDOWS
        hashes = rows.column(4)
        offsets = np.frombuffer(hashes.buffers()[1], np.int32)[hashes.offset : hashes.offset + len(rows) + 1]
        n = np.diff(offsets) // BYTES
        data = np.zeros((int(n.sum()), 8), np.uint8)
        data[:, :BYTES] = np.frombuffer(hashes.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, BYTES)
        key = mix(data.view(np.uint64).reshape(-1) + np.repeat(mix(route), n))
        within = np.arange(len(key)) - np.repeat(np.cumsum(n) - n, n)
        own = key, np.repeat(rows.column(1).to_numpy(), n), np.repeat(rows.column(2).to_numpy().astype(np.int64), n) + within
        size += len(key)
        last = route[-1]
        if size >= WINDOWS and route[0] != last:  # all but this batch's last route is complete
            at = int(n[: int(np.flatnonzero(route != last)[-1]) + 1].sum())
            held.append(tuple(x[:at] for x in own))
            yield from found()
            held, size, full = [], len(key) - at, 2 * WINDOWS
            own = tuple(x[at:] for x in own)
        held.append(own)
        if size >= full:  # one route of many windows
            yield from found()
            size = len(held[0][0])
            full = 2 * max(WINDOWS, size)
    if held:
        yield from found()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maximal intervals, from intervals in order of document and start."""
    last: tuple[int, int, int] | None = None
    for batch in batches:
        if not len(batch):
            continue
        doc, start, stop = (c.to_numpy().astype(np.int64) for c in batch.columns)
        if last is not None:
            doc, start, stop = np.append(last[0], doc), np.append(last[1], start), np.append(last[2], stop)
        # The farthest end so far in a document: ends of later documents are lifted over those of earlier ones.
        lift = np.cumsum(np.append(0, doc[1:] != doc[:-1])) * (int(stop.max()) + 1)
        far = np.maximum.accumulate(stop + lift) - lift
        begin = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (start[1:] > far[:-1])))
        end = np.append(begin[1:], len(doc)) - 1
        out = doc[begin], start[begin], far[end]
        last = tuple(int(x[-1]) for x in out)  # it may go on in the next batch
        yield pa.RecordBatch.from_arrays([pa.array(out[0][:-1]), *(pa.array(x[:-1].astype(np.int32)) for x in out[1:])], names=["doc", "start", "stop"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int64()), pa.array([last[1]], pa.int32()), pa.array([last[2]], pa.int32())], names=["doc", "start", "stop"])


def removals(documents: DataFrame) -> DataFrame:
    """doc, start, stop: the words [start, stop) of a document that repeat one with a smaller id, as maximal intervals."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).where("doc is not null and text is not null")
    counted = texts.mapInArrow(_routes, "route long, lo long, hi long").groupBy("route").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("rows"))
    routes = materialize(counted.where("lo < hi").select("route", "rows"), "routes")
    common = spark.sparkContext.broadcast(bloom.of(routes.where(F.col("rows") > COMMON), "route"))
    shared = spark.sparkContext.broadcast(bloom.of(routes, "route"))
    runs = texts.mapInArrow(_windows(shared, common), RUNS).repartition("route").sortWithinPartitions("route")
    spans = runs.mapInArrow(_compare, "doc long, start int, stop int")
    return materialize(spans.repartition("doc").sortWithinPartitions("doc", "start").mapInArrow(_merge, "doc long, start int, stop int"), "intervals")


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, ROWS) for b in batches for at in range(0, len(b), ROWS)):
        words, removed, kept = [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            own = (text or "").encode().split()  # bytes are split at space and 0x09-0x0D, no others
            words.append(len(own))
            if spans:
                mask = np.zeros(len(own) + 1, np.int64)
                for s in spans:
                    mask[s["start"]] += 1
                    mask[s["stop"]] -= 1
                stay = (np.cumsum(mask)[:-1] == 0).tolist()
                own = list(compress(own, stay))
            removed.append(words[-1] - len(own))
            kept.append(b" ".join(own).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])


def dedup_substrings(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the kept words joined by one space) of every document."""
    gone = removals(documents)
    held = documents.sparkSession.sparkContext.broadcast(bloom.of(gone.select("doc").distinct().select(F.xxhash64("doc").alias("h")), "h"))

    def concerned(batch: pa.RecordBatch) -> np.ndarray:
        return bloom.within(held.value, batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(concerned(batch))).select([0, 1])

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.filter(pa.array(~concerned(batch)))
            yield from _keep(iter([pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.nulls(len(own))], names=["doc_id", "text", "spans"])]))

    spans = gone.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("doc_id"))
    out = "doc_id long, n_words long, n_removed long, kept_text string"
    joined = rows.mapInArrow(some, "doc_id long, text string").join(spans, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_keep, out).unionByName(rows.mapInArrow(rest, out))
