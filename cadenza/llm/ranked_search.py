"""Ranked lexical search by pipelined term partitioning (Moffat et al., 2007), with integer scores.

Terms are dealt to a few owners. A bundle is a block of items against a lane of documents; it carries the sparse
accumulators of its (item, document) pairs through the owners' stages one after the other. In each stage it
is cogrouped with the owner's postings of its lane, and the contributions of these terms are added. After the last
stage each bundle gives the highest documents of each item, and these are ranked over all lanes.

Lanes (LANE documents) and bundles (BUNDLE items) bound what a group holds, whatever the size of the tables and however
frequent a term is: a term of all documents is one posting row a lane. Postings hold terms of items only, are
written once, and all statistics are counted over all documents. No accumulator is dropped on the way.

Cases: a null or empty text has no terms; an item without terms, or whose terms are in no document, gives no rows. Each
row of ``documents`` and of ``items`` counts on its own, repeated ids and null ids included; equal scores are ranked by
doc_id, nulls last. An empty table of either kind gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.scratch import materialize
from cadenza.llm.words import buffers

LANE, BUNDLE, STAGES = 2048, 256, 4
#: Terms of items that are broadcast to the scan (without it, postings of all terms are made and joined), and rows of the
#: index of items that are broadcast to the postings (else both are joined in a shuffle, salted by lane).
MOST_TERMS, MOST_INDEX, SALTS = 1_000_000, 1_000_000, 16
#: Lanes are ranked in so many parts before they are ranked together.
PARTS = 64
#: Bytes of a term: 0-9, A-Z (lower-cased), a-z and all of other scripts; what else ASCII has parts terms.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_TERMS = "bundle long, item int, item_id long, term binary"
_POSTINGS = "owner int, lane long, term binary, n_docs int, docs binary, counts binary, ids array<long>, sizes binary"
_ACCUMULATORS = "lane long, bundle long, ids array<long>, sizes binary, places binary, scores binary"
_FOUND = "bundle long, item int, lane long, doc_id long, score long"


def _terms(texts: pa.Array) -> Iterator[list[bytes]]:
    """The terms of each text in order, with repeats."""
    offsets, data = buffers(texts)
    whole = memoryview(data)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield bytes(whole[a:b]).translate(_TERM).split()


def _numbered(rows: int, size: int) -> Iterator[tuple[int, int, int]]:
    """Blocks (from, to) of at most ``size`` rows with a number that no other block of the job has."""
    base = TaskContext.get().partitionId() << 32
    yield from ((base, at, min(rows, at + size)) for at in range(0, rows, size))


def item_terms(items: DataFrame) -> DataFrame:
    """bundle, item (number in its bundle), item_id, term: the different terms of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = 0
        for batch in batches:
            for base, at, to in _numbered(len(batch), BUNDLE):
                ids = batch.column(0)[at:to].to_pylist()
                rows = [(base + block, k, ids[k], t) for k, terms in enumerate(_terms(batch.column(1)[at:to])) for t in dict.fromkeys(terms)]
                block += 1
                columns = zip(*rows, strict=True) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["bundle", "item", "item_id", "term"])

    return items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _TERMS)


def postings(documents: DataFrame, vocabulary: frozenset[bytes] | None) -> DataFrame:
    """One row a lane (ids and numbers of terms of its documents), and one a lane and term of ``vocabulary`` (all if None): the
    documents' places in the lane and how often they hold the term."""
    spark = documents.sparkSession
    wanted = spark.sparkContext.broadcast(vocabulary)

    def lane_rows(lane: int, ids: pa.Array, texts: pa.Array) -> Iterator[tuple]:
        keep = wanted.value
        sizes, held = np.zeros(len(ids), np.int64), {}
        for doc, terms in enumerate(_terms(texts)):
            sizes[doc] = len(terms)
            for term, n in Counter(terms if keep is None else filter(keep.__contains__, terms)).items():
                docs, counts = held.setdefault(term, ([], []))
                docs.append(doc)
                counts.append(n)
        yield -1, lane, None, len(ids), None, None, ids.to_pylist(), sizes.tobytes()
        for term, (docs, counts) in held.items():
            yield zlib.crc32(term) % STAGES, lane, term, len(docs), np.array(docs, np.uint16).tobytes(), np.array(counts, np.uint32).tobytes(), None, None

    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary())
    names = [f.split()[0] for f in _POSTINGS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = 0
        for batch in batches:
            for base, at, to in _numbered(len(batch), LANE):
                rows = list(lane_rows(base + block, batch.column(0)[at:to], batch.column(1)[at:to]))
                block += 1
                for k in range(0, len(rows), 4096):
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows[k : k + 4096], strict=True), kinds, strict=True)], names=names)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _POSTINGS)


def _stage(documents: int, terms: int):
    """Adds the contributions of one owner's terms to the accumulators of one bundle and lane."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):  # postings of a lane always meet its bundles
            return left
        row = left.to_pylist()[0]
        sizes = np.frombuffer(row["sizes"], np.int64)
        m = 20 * (50 + 50 * sizes * documents // max(1, terms))
        sums = np.zeros((BUNDLE, len(sizes)), np.int64)
        sums.reshape(-1)[np.frombuffer(row["places"], np.int32)] = np.frombuffer(row["scores"], np.int64)
        for weight, items, docs, counts in zip(*(right[c].to_pylist() for c in ("weight", "items", "docs", "counts")), strict=True):
            at, tf = np.frombuffer(docs, np.uint16).astype(np.int64), np.frombuffer(counts, np.uint32).astype(np.int64)
            sums[np.ix_(items, at)] += weight * ((1_000_000_000 * tf) // (1000 * tf + m[at]))
        places = np.flatnonzero(sums)
        row["places"], row["scores"] = places.astype(np.int32).tobytes(), sums.reshape(-1)[places].tobytes()
        return pa.Table.from_pylist([row], left.schema)

    return run


def _highest(top: int):
    """The ``top`` documents of each item of a bundle in one lane, all documents of equal scores in order of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places, scores = np.frombuffer(row["places"], np.int32), np.frombuffer(row["scores"], np.int64)
                none = np.array([i is None for i in row["ids"]], bool)
                ids = np.array([0 if i is None else i for i in row["ids"]], np.int64)
                item, doc = np.divmod(places, max(1, len(ids)))
                edge = np.searchsorted(item, np.arange(BUNDLE + 1))
                found = []
                for k in np.flatnonzero(np.diff(edge)).tolist():
                    d, s = doc[edge[k] : edge[k + 1]], scores[edge[k] : edge[k + 1]]
                    best = np.lexsort((ids[d], none[d], -s))[:top]
                    found.append((np.full(len(best), k), d[best], s[best]))
                if found:
                    item, doc, score = (np.concatenate(c) for c in zip(*found, strict=True))
                    fixed = [pa.array(np.full(len(item), row[c]), pa.int64()) for c in ("bundle", "lane")]
                    yield pa.RecordBatch.from_arrays([fixed[0], pa.array(item, pa.int32()), fixed[1], pa.array(ids[doc], pa.int64(), mask=none[doc]), pa.array(score, pa.int64())], names=["bundle", "item", "lane", "doc_id", "score"])

    return run


def search(documents: DataFrame, items: DataFrame, top: int = 50) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score: the ``top`` documents of highest score over 0 for each row of ``items``.

    A term of weight w = floor(1000 ln((2 N + 2) / (2 df + 1))) that a document of length n holds tf times adds
    w * (10**9 tf div (1000 tf + 20 m)), m = 50 + 50 n N div L, for N documents with terms and L terms in all.
    """
    spark = documents.sparkSession
    asked = materialize(item_terms(items), "item-terms")
    distinct = asked.select("term").distinct()
    words = distinct.take(MOST_TERMS + 1)
    table = materialize(postings(documents, frozenset(bytes(w[0]) for w in words) if len(words) <= MOST_TERMS else None), "postings", by=("owner",))
    of_terms, lanes = table.where("owner >= 0"), table.where("owner = -1").select("lane", "ids", "sizes")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = [np.frombuffer(b, np.int64) for b in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int((x > 0).sum()) for x in s], pa.int64()), pa.array([int(x.sum()) for x in s], pa.int64())], names=["n", "l"])

    n, total = lanes.select("sizes").mapInArrow(lengths, "n long, l long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("l"), F.lit(0))).first()

    # Of each term in a bundle: its weight, and the numbers of the items that have it.
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("long")
    df = of_terms.groupBy("term").agg(F.sum("n_docs").alias("df")).select("term", weight.alias("weight"))
    index = materialize(asked.groupBy("bundle", "term").agg(F.collect_list("item").alias("items")).join(df, "term"), "term-index")
    if index.count() <= MOST_INDEX:
        met = of_terms.join(F.broadcast(index), "term")
    else:
        spread = index.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("term", "_term")
        met = of_terms.join(spread, (F.col("term") == F.col("_term")) & (F.pmod("lane", F.lit(SALTS)) == F.col("_salt")))
    met = met.select("owner", F.col("lane").alias("lane"), F.col("bundle").alias("bundle"), "weight", "items", "docs", "counts")

    bundles = [r[0] for r in asked.select("bundle").distinct().collect()]
    empty = F.lit(b"").alias("places"), F.lit(b"").alias("scores")
    carried = lanes.select(F.col("lane").alias("lane"), F.explode(F.array(*map(F.lit, bundles)).cast("array<long>")).alias("bundle"), "ids", "sizes", *empty)
    for owner in range(STAGES):
        part = met.where(F.col("owner") == owner).drop("owner")
        carried = carried.groupBy("lane", "bundle").cogroup(part.groupBy("lane", "bundle")).applyInArrow(_stage(n, total), _ACCUMULATORS)
    found = carried.mapInArrow(_highest(top), _FOUND)

    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    part = Window.partitionBy("bundle", "item", F.pmod("lane", F.lit(PARTS))).orderBy(*order)
    whole = Window.partitionBy("bundle", "item").orderBy(*order)
    best = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top).withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    named = asked.select("bundle", "item", "item_id").distinct()
    return best.join(named, ["bundle", "item"]).select("item_id", "rank", "doc_id", "score")
