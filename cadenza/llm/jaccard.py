"""N-gram Jaccard join (operator 3): documents whose sets of five-word shingles are alike, exactly.

The Jaccard distance 1 - |x & y| / |x | y| is a metric, and documents link at a distance of at most 0.2.

1. Equal sets become one node (by size and a 128-bit sum of their hashes), so copies cost one row a task.
2. Cells. Under any total order of shingles, two linked sets share one of their first
   n - ceil(0.8 n) + 1 shingles. The order here is by hash, with frequent shingles last (frequent ones are
   counted over all documents; what the count misses changes the order for all alike, never the result).
   All nodes with a shingle in this prefix are one cell.
3. Pivots. The node of a cell with the smallest share of rare shingles is its pivot - the least edited of a
   family of copies, to which the others are nearest; cells with the same pivot are one region, and a node lies
   in the region of each pivot it shares a cell with. Each node's exact distance is computed to the pivot it
   shares most cells with, then to those of its pivots that are not joined to it yet; at most 0.2 links.
   A region of n alike documents so costs about n distances and not n * n. Before texts are fetched, sketches
   (the sets' counts in classes of shingles) rule pairs out whose symmetric difference must be too large.
4. Recursion. What may be missing are links between nodes of one region that are not joined yet. In regions
   with more than one component the nodes outside the largest become pivots in turn; a node is compared with a new
   pivot only if it is in another component, sizes and sketches allow 0.8, and the triangle inequality does:
   |d(x, p) - d(y, p)| <= 0.2 for the region's pivot p. The nodes used as pivots leave the region; this goes
   on until no region holds two components. Regions of at most REGION_NODES nodes do this within one task,
   from lists of the nodes of each shingle. No pair is dropped or capped.

Plan: the texts are scanned twice with two columns; one row a prefix shingle is shuffled (16 bytes), then
only pairs with a pivot, which fetch their texts by id (a shuffled join that adaptive execution splits
where one pivot has very many nodes) from a table of the texts that are in such a pair. Components are found by ``graph.components``.

Cases: null texts and texts without words have an empty set and link with nothing; fewer than five words
are one shingle. Ties and repeated rows are ordinary: each row is returned. Rows that share a doc_id but not a text are
one document in the links. Rows with a null doc_id link with equal sets only. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.graph import components
from cadenza.llm.scratch import materialize, release
from cadenza.llm.shards import number_rows
from cadenza.llm.words import mix, shingle_sets

#: Frequent shingles that go last in the order: at most so many are broadcast (16 bytes each).
HOT_TABLE = 1 << 18
#: A task reports a shingle that is in at least so many of the different sets among the FLUSH shingles before.
HOT_LOCAL, FLUSH = 2, 1 << 20
#: Nodes of a region that become pivots in one round.
PIVOTS = 256
#: Pairs of texts that are cut into shingles at once.
PAIRS = 256
#: A region of at most so many nodes and shingles is joined in one task; larger ones take rounds.
REGION_NODES, REGION_SHINGLES = 4096, 1 << 22
#: A sketch counts a set's shingles in 2**k classes, about 4 to 8 a class, a byte each.
SKETCH_BITS = 4, 14
SURVEY = "doc_id long, n long, s1 long, s2 long, sketch binary, shingle long, seen long"
_SURVEY = ["doc_id", "n", "s1", "s2", "sketch", "shingle", "seen"]


def _prefix(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1 if n else 0


def sketch(s: np.ndarray) -> bytes:
    """How many shingles of a sorted set fall in each class (the hash's top bits), at most 255."""
    bits = min(max((len(s) // 4).bit_length() - 1, SKETCH_BITS[0]), SKETCH_BITS[1])
    return np.minimum(np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def apart(x: bytes, y: bytes) -> int:
    """At most |A - B| + |B - A| of the two sets sketched: the classes' differences summed; the finer sketch is folded."""
    a, b = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    while len(a) > len(b):
        a = a[0::2] + a[1::2]
    while len(b) > len(a):
        b = b[0::2] + b[1::2]
    full = (a >= 255) | (b >= 255)  # a class at its limit tells nothing
    return int(np.abs(a - b)[~full].sum())


def _key(s: np.ndarray) -> tuple[int, int, int]:
    """A set's size and two sums of hashes of its shingles."""
    return len(s), *(int(mix(s ^ np.uint64(k)).sum(dtype=np.uint64).view(np.int64)) for k in (0x243F6A8885A308D3, 0x13198A2E03707344))


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document (size, hash and sketch of its set), and one for each shingle that is frequent here."""
    held, size, sets = [], 0, set()

    def frequent() -> pa.RecordBatch:
        x, n = np.unique(np.concatenate(held), return_counts=True)
        x, n = x[n >= HOT_LOCAL], n[n >= HOT_LOCAL]
        none = pa.nulls(len(x), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(x), pa.binary()), pa.array(x.view(np.int64)), pa.array(n.astype(np.int64))], names=_SURVEY)

    for batch in batches:
        rows, sketches = np.zeros((len(batch), 3), np.int64), [b""] * len(batch)
        for i, s in shingle_sets(batch.column(1)):
            rows[i] = _key(s)
            sketches[i] = sketch(s)
            if rows[i, 1] not in sets:
                sets.add(int(rows[i, 1]))
                held.append(s[: 2 * _prefix(len(s))])
                size += len(held[-1])
        none = pa.nulls(len(batch), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(rows[:, k]) for k in range(3)), pa.array(sketches, pa.binary()), none, none], names=_SURVEY)
        if size >= FLUSH:
            yield frequent()
            held, size, sets = [], 0, set()
    if held:
        yield frequent()


def _prefixes(hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, rank = hot.value  # sorted shingles, and how frequent each is among them
        for batch in batches:
            rare, keys, edge, late_keys, late_edge = [], [], [0], [], [0]
            for _, s in shingle_sets(batch.column(1)):
                p, known = _prefix(len(s)), np.zeros(len(s), bool)
                if len(value) and len(s):
                    at = np.minimum(np.searchsorted(value, s), len(value) - 1)
                    known = value[at] == s
                first = s[~known][:p]
                late = s[known]
                late = late[np.argsort(rank[at[known]], kind="stable")][: p - len(first)] if len(first) < p else late[:0]
                rare.append(1000 * int((~known).sum()) // max(1, len(s)))
                for own, held, ends in ((first, keys, edge), (late, late_keys, late_edge)):
                    held.append(own)
                    ends.append(ends[-1] + len(own))
            lists = [pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(np.concatenate([np.zeros(0, np.uint64), *held]).view(np.int64))) for held, ends in ((keys, edge), (late_keys, late_edge))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(rare, np.int64)), *lists], names=["doc", "rare", "keys", "frequent"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shared shingles of pairs of texts (a, b, ta, tb); a text that comes several times is cut once."""
    for batch in (b.slice(at, PAIRS) for b in batches for at in range(0, len(b), PAIRS)):
        a = batch.column(0).to_numpy(zero_copy_only=False)
        firsts, which = np.unique(a, return_index=True, return_inverse=True)[1:]
        left = [s for _, s in shingle_sets(batch.column(2).take(pa.array(firsts)))]
        out = np.zeros((len(batch), 3), np.int64)
        for i, y in shingle_sets(batch.column(3)):
            x = left[which[i]]
            few, many = (x, y) if len(x) <= len(y) else (y, x)
            shared = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum()) if len(few) else 0
            out[i] = shared, len(x), len(y)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(out[:, k]) for k in range(3))], names=["a", "b", "shared", "na", "nb"])


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, shared, na, nb and dist (the exact Jaccard distance) for pairs (a, b) of ids of ``texts`` (doc, text).

    Pairs are written first: where there are none, no text is read.
    """
    schema = "a long, b long, shared long, na long, nb long, dist double"
    pairs = materialize(pairs.select("a", "b"), "pairs")
    if pairs.isEmpty():
        return pairs.sparkSession.createDataFrame([], schema)
    left = texts.select(F.col("doc").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("doc").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    out = both.mapInArrow(_shared, "a long, b long, shared long, na long, nb long")
    return materialize(out.withColumn("dist", 1 - F.col("shared") / F.greatest(F.lit(1), F.col("na") + F.col("nb") - F.col("shared"))), "distances")


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, na, nb, sa, sb) whose sketches allow a similarity of 0.8: a symmetric difference of at most a ninth of the sizes."""
    for batch in batches:
        na, nb, sa, sb = (batch.column(k).to_pylist() for k in range(2, 6))
        fit = [9 * apart(x, y) <= m + n for m, n, x, y in zip(na, nb, sa, sb, strict=True)]
        yield batch.filter(pa.array(fit, pa.bool_())).select([0, 1, 2, 3])


def possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that may link, by size and sketch; ``sketches`` has node, n and sketch."""
    left = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").where("5 * least(na, nb) >= 4 * greatest(na, nb)")
    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_possible, "a long, b long, na long, nb long").select("a", "b")


def _fitting(pivot: int, doc: np.ndarray, n: np.ndarray, sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Which nodes of one region may link with another of its nodes, by size and sketch, and which with the pivot.

    Sketches of one length are compared as a matrix, with those of twice the length folded. Counts stop at 255,
    which only brings sums closer.
    """
    length = np.array([len(x) for x in sketches])
    may, able = np.zeros(len(doc), bool), np.zeros(len(doc), bool)
    for size in np.unique(length):
        own, twice = np.flatnonzero(length == size), np.flatnonzero(length == 2 * size)
        rows = np.concatenate([own, twice])
        if len(rows) < 2:
            continue
        m = np.frombuffer(b"".join(sketches[i] for i in own), np.uint8).reshape(len(own), size).astype(np.int16)
        if len(twice):
            fine = np.frombuffer(b"".join(sketches[i] for i in twice), np.uint8).reshape(len(twice), 2 * size).astype(np.int16)
            m = np.concatenate([m, np.minimum(fine[:, 0::2] + fine[:, 1::2], 255)])
        for k, i in enumerate(own):
            fit = (5 * np.minimum(n[rows], n[i]) >= 4 * np.maximum(n[rows], n[i])) & (9 * np.abs(m - m[k]).sum(axis=1, dtype=np.int64) <= n[rows] + n[i])
            fit[k] = False
            hit = rows[fit]
            if len(hit):
                may[hit] = may[i] = True
                if doc[i] == pivot:
                    able[hit] = True
                elif (doc[hit] == pivot).any():
                    able[i] = True
    return may, able


def _suspects(pdf: pd.DataFrame) -> pd.DataFrame:
    """The nodes of small regions that may link at all; ``able``: with the pivot. A frame holds whole regions."""
    pdf = pdf.sort_values("pivot", kind="stable", ignore_index=True)
    pivot, doc, n, sketches = pdf["pivot"].to_numpy(), pdf["doc"].to_numpy(), pdf["n"].to_numpy(), pdf["sketch"].tolist()
    may, able = np.zeros(len(pdf), bool), np.zeros(len(pdf), bool)
    begin = np.flatnonzero(np.r_[True, pivot[1:] != pivot[:-1]])
    for s, e in zip(begin, np.r_[begin[1:], len(pdf)], strict=True):
        may[s:e], able[s:e] = _fitting(pivot[s], doc[s:e], n[s:e], sketches[s:e])
    return pdf.loc[may, ["pivot", "doc", "cells"]].assign(able=able[may])


def _region(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that join the components of one small region: each node outside the largest is held against all others.

    A list of the nodes of each shingle gives one node's shared shingles with all at once.
    """
    sets = [s for _, s in shingle_sets(pa.array(pdf["text"], pa.string(), from_pandas=True))]
    n, doc = np.array([len(s) for s in sets]), pdf["doc"].to_numpy()
    names, root = np.unique(pdf["root"].to_numpy(), return_inverse=True)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    up = np.arange(len(names))
    out: list[tuple[int, int]] = []
    for i in np.flatnonzero(root != np.bincount(root).argmax()):
        lo, hi = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
        many = hi - lo
        at = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
        shared = np.bincount(owner[at], minlength=len(sets))
        for x in np.flatnonzero(100 * shared >= 80 * (n + n[i] - shared)):
            a, b = up[root[x]], up[root[i]]
            if a != b:
                up[up == max(a, b)] = min(a, b)
                out.append((doc[x], doc[i]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def rooted(df: DataFrame, roots: DataFrame, node: str, name: str) -> DataFrame:
    """``df`` with the root of the column ``node``; a node without links is its own root."""
    own = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return df.join(own, F.col(node) == F.col("_node"), "left").withColumn(name, F.coalesce("_root", node)).drop("_node", "_root")


def _named(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` (with n, s1, s2) and the node ``rep`` of each set. A set that over a thousandth of the rows have is in a table of under 1,000 sets, which is broadcast."""
    key = ["n", "s1", "s2"]
    total = rows.count()
    common = F.broadcast(nodes.where(F.col("copies") * 1000 > total).select(*key, "rep"))
    rest = rows.join(common, key, "left_anti").join(nodes.where(F.col("copies") * 1000 <= total).select(*key, "rep"), key, "left")
    return rows.join(common, key).unionByName(rest)


def join_documents(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every document."""
    return classes(documents).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def classes(documents: DataFrame) -> DataFrame:
    """doc_id, n, s1, s2 (a set's size and hash) and component_id of every document."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    survey = materialize(texts.mapInArrow(_survey, SURVEY), "survey")
    rows = survey.where("n is not null").select("doc_id", "n", "s1", "s2")
    nodes = rows.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    sketches = survey.where("n > 0").select(F.col("doc_id").alias("node"), "n", "sketch")

    top = survey.where("seen is not null").groupBy("shingle").agg(F.sum("seen").alias("seen")).orderBy(F.desc("seen"), "shingle").limit(HOT_TABLE).toArrow()
    value, rank = top["shingle"].to_numpy().view(np.uint64), top["seen"].to_numpy()
    order = np.argsort(value)
    hot = spark.sparkContext.broadcast((value[order], rank[order]))

    prefixes = texts.mapInArrow(_prefixes(hot), "doc long, rare long, keys array<long>, frequent array<long>").join(nodes.select(F.col("rep").alias("doc")), "doc", "left_semi")
    prefixes = materialize(prefixes, "prefixes")
    # Few nodes share a rare shingle, and one shuffle serves; a frequent one may be a third of all nodes', so its pivot comes from partial minima.
    cell = Window.partitionBy("key")
    rare = prefixes.select("doc", "rare", F.explode("keys").alias("key")).select("doc", F.count("*").over(cell).alias("size"), F.min(F.struct("rare", "doc")).over(cell).alias("p"))
    often = prefixes.select("doc", "rare", F.explode("frequent").alias("key"))
    often = often.select("key", "doc").join(often.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("rare", "doc")).alias("p")), "key").select("doc", "size", "p")
    cells = rare.unionByName(often)
    regions = materialize(cells.where("size > 1").groupBy(F.col("p.doc").alias("pivot"), "doc").agg(F.count("*").alias("cells")), "regions")
    release(prefixes)
    # What may link at all, by sketch: in small regions each node with any other, in large ones with the pivot.
    known = regions.join(sketches.withColumnRenamed("node", "doc"), "doc")
    sizes = known.groupBy("pivot").agg(((F.count("*") <= REGION_NODES) & (F.sum("n") <= REGION_SHINGLES)).alias("small"))
    sketches = materialize(sketches.join(regions.select(F.col("doc").alias("node")).distinct(), "node", "left_semi"), "sketches")
    large = materialize(regions.join(sizes.where("not small"), "pivot").select("pivot", "doc", "cells"), "large")
    small = known.join(large.select("pivot").distinct(), "pivot", "left_anti").select("pivot", "doc", "cells", "n", "sketch")
    parts = max(1, regions.count() // max(1, REGION_NODES))
    kept = small.groupBy(F.pmod(F.xxhash64("pivot"), F.lit(parts)).alias("part")).applyInPandas(_suspects, "pivot long, doc long, cells long, able boolean").withColumn("small", F.lit(True))
    if not large.isEmpty():
        fit = possible(large.where("doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")), sketches).select(F.col("a").alias("pivot"), F.col("b").alias("doc"), F.lit(True).alias("able"))
        kept = kept.unionByName(large.join(fit, ["pivot", "doc"], "left").withColumn("able", F.coalesce("able", F.lit(False))).withColumn("small", F.lit(False)))
    regions = materialize(kept, "suspects")
    # The texts move once, whatever the size, so that the plan doesn't change with it.
    texts = materialize(texts.join(regions.select("doc").distinct().hint("merge"), "doc", "left_semi"), "texts")

    alike = "100 * shared >= 80 * (na + nb - shared)"
    able = regions.where("able and doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b"), "cells")
    # First each node against the pivot it shares most cells with; then what that left apart.
    nearest = able.groupBy("b").agg(F.max(F.struct("cells", (-F.col("a")).alias("p"))).alias("m")).select((-F.col("m.p")).alias("a"), "b")
    stars = compare(nearest, texts)
    links = stars.where(alike).select("a", "b")
    # Two steps from a node to its pivot, and on to that one's, tell most pairs that are joined already.
    pivot = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = rooted(pivot, pivot, "root", "far").select("node", F.col("far").alias("root"))
    rest = able.select("a", "b").join(nearest, ["a", "b"], "left_anti")
    rest = rooted(rooted(rest, roots, "a", "ra"), roots, "b", "rb").where("ra <> rb").select("a", "b")
    more = compare(rest, texts)
    links = links.unionByName(more.where(alike).select("a", "b"))
    roots = materialize(components(links), "roots")

    known = stars.unionByName(more).select(F.col("a").alias("pivot"), F.col("b").alias("doc"), "dist").distinct()
    placed = rooted(regions.select("pivot", "doc", "small"), roots, "doc", "root")
    mixed = placed.groupBy("pivot").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("pivot")
    mixed = materialize(placed.join(mixed, "pivot").select("pivot", "doc", "root", "small"), "mixed")
    # Small regions at once, each in a task.
    found = materialize(mixed.where("small").join(texts, "doc").groupBy("pivot").applyInPandas(_region, "a long, b long"), "found")
    if not found.isEmpty():
        links = links.unionByName(found)
        roots = materialize(components(links), "roots")
    # Large ones in rounds.
    left = mixed.where("not small").select("pivot", "doc").join(known, ["pivot", "doc"], "left").withColumn("dist", F.when(F.col("doc") == F.col("pivot"), 0.0).otherwise(F.col("dist")))
    rounds = not mixed.where("not small").isEmpty()
    while rounds:
        placed = rooted(left, roots, "doc", "root")
        shares = placed.groupBy("pivot", "root").agg(F.count("*").alias("nodes"))
        mixed = shares.groupBy("pivot").agg(F.max(F.struct("nodes", "root")).alias("m"), F.count("*").alias("roots")).where("roots > 1").select("pivot", F.col("m.root").alias("main"))
        placed = materialize(placed.join(mixed, "pivot").select("pivot", "doc", "dist", "root", "main"), "mixed")
        # The nodes outside a region's largest component are numbered; when they have all been pivots, the rest is one component.
        outside = placed.where("root <> main")
        count = outside.count()
        if not count:
            break
        outside = number_rows(outside, "pivot", ["doc"], count, "rank")
        ranked = materialize(outside.unionByName(placed.where("root = main").withColumn("rank", F.lit(None).cast("long"))), "ranked")
        release(placed)
        new = ranked.where(F.col("rank") < PIVOTS).select("pivot", *(F.col(c).alias(f"c_{c}") for c in ("doc", "dist", "root", "rank")))
        near = (F.abs(F.col("dist") - F.col("c_dist")) <= 0.2 + 1e-9) | F.col("dist").isNull() | F.col("c_dist").isNull()
        pairs = ranked.join(new, "pivot").where("(rank is null or rank > c_rank) and root <> c_root").where(near).select(F.col("c_doc").alias("a"), F.col("doc").alias("b")).distinct()
        found = compare(possible(pairs, sketches), texts).where(alike).select("a", "b")
        if not found.isEmpty():
            links = links.unionByName(found)
            roots = materialize(components(links), "roots")
        left = ranked.where(F.col("rank").isNull() | (F.col("rank") >= PIVOTS)).select("pivot", "doc", "dist")

    joined = _named(rows, nodes).join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    return joined.select("doc_id", "n", "s1", "s2", F.coalesce("root", "rep", "doc_id").alias("component_id"))


def one_of_each(documents: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: one with the smallest doc_id. All rows without words stay.

    Of rows with a null doc_id one of each set stays, if no row with an id has the set.
    """
    known = materialize(classes(documents), "classes")
    gone = known.where("doc_id <> component_id").select(F.col("doc_id").alias("_id")).distinct()
    again = known.where("n > 0 and doc_id = component_id").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_id"))
    unnamed = known.where("doc_id is null")
    if again.isEmpty() and unnamed.isEmpty():
        return documents.join(gone, documents["doc_id"].cast("long") == gone["_id"], "left_anti")
    # The row is kept apart, so that no column of it clashes with one made here.
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    kept = rows.where("_id is not null").join(gone, "_id", "left_anti")
    once = kept.join(again, "_id", "left_anti").select("_row")

    @F.pandas_udf("n long, s1 long, s2 long")
    def key(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_key(s) for _, s in shingle_sets(pa.array(texts, pa.string(), from_pandas=True))], columns=["n", "s1", "s2"], dtype="int64")

    keyed = lambda df: df.select("_row", "_id", key("_text").alias("k")).select("_row", "_id", "k.*")
    # Rows with an id in common: one of each set.
    more = keyed(kept.join(again, "_id", "left_semi"))
    nameless = keyed(rows.where("_id is null"))
    one = nameless.where("n > 0").dropDuplicates(["n", "s1", "s2"]).join(known.where("doc_id is not null").select("n", "s1", "s2"), ["n", "s1", "s2"], "left_anti")
    parts = [more.where("n > 0").dropDuplicates(["_id", "n", "s1", "s2"]), more.where("n = 0"), one, nameless.where("n = 0")]
    for part in parts:
        once = once.unionByName(part.select("_row"))
    return once.select("_row.*")
