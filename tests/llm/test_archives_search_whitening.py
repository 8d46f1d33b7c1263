"""Archives, ranked search and whitening against brute force, their SQL and broken input."""

import base64
import hashlib
import io
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from cadenza.llm import decontaminate, queries, ranked_search, substrings, warc, whitening
from cadenza.llm import words as W
from cadenza.llm.scratch import new_path
from tests.llm.conftest import words as make_words

PAGES = "page_id long, url string, html string"
VECTORS = "vec_id long, embedding array<float>, label int"
DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def base32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


# --- words -------------------------------------------------------------------------------------------------------


def test_words_of_a_form_do_not_collide(spark, write):
    """Thue-Morse words and their complements collide under polynomials modulo a power of two."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, other = ("".join(pair[b] for b in bits) for pair in ("ab", "ba"))
    got = [h for w in W.words_of(pa.array([one, other]), False) for h in w.hashes.tolist()]
    assert got[0] != got[1]
    rows = [(1, one), (2, other), (3, " ".join([one, *make_words(random.Random(1), 60)])), (4, " ".join([other, *make_words(random.Random(1), 60)]))]
    d = write(spark, documents=(rows, DOCS), benchmark=([(1, " ".join([one, *make_words(random.Random(2), 4)]))], ITEMS))
    assert {r.component_id for r in queries.op3_jaccard_join(spark, d).collect()} == {1, 2, 3}
    assert {r.doc_id: r.n_removed for r in queries.op5_substring_dedup(spark, d).collect()} == {1: 0, 2: 0, 3: 0, 4: 60}
    swapped = spark.createDataFrame([(1, " ".join([other, *make_words(random.Random(2), 4)]))], DOCS)
    assert decontaminate.containments(swapped, spark.read.parquet(f"{d}/benchmark.parquet"), 0.8).count() == 0
    assert substrings is not None


# --- archives ----------------------------------------------------------------------------------------------------


def pages():
    rng = random.Random(3)
    texts = [f"<p>{' '.join(make_words(rng, 80))}</p>" for _ in range(60)]
    rows = [(k, f"http://h/{k}", t) for k, t in enumerate(texts)]
    rows += [(100 + k, None, texts[k % 5]) for k in range(40)]  # copies
    rows += [(200, "http://h/a b\r\nX: 1", ""), (201, "é", None), (202, "u", "é\x00\r\n\r\nWARC/1.1"), (None, "u", texts[0]), (None, "u", "alone"), (300, "u", "twice"), (300, "u", "twice"), (301, "u", "x" * 300_000)]
    return rows


def expected(rows):
    last = {}
    for p, _, t in rows:
        last[t or ""] = max((x for x in (last.get(t or ""), p) if x is not None), default=None)
    out = []
    for p, _, t in rows:
        again = last[t or ""] is not None and p != last[t or ""]
        out.append((p, len((t or "").encode()), base32(t), "revisit" if again else "response", last[t or ""] if again else None))
    return sorted(out, key=str)


def read_back(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_op11_matches_brute_force(spark, write):
    d = write(spark, pages=(pages(), PAGES))
    assert read_back(queries.op11_warc(spark, d)) == expected(pages())


def test_op11_joins_many_groups_in_a_shuffle(spark, write, monkeypatch):
    monkeypatch.setattr(warc, "MOST_GROUPS", 0)
    d = write(spark, pages=(pages(), PAGES))
    assert read_back(queries.op11_warc(spark, d)) == expected(pages())


def test_archives_hold_payloads_and_urls(spark):
    path = new_path(spark, "archives")
    rows = pages()
    warc.write_pages(spark.createDataFrame([(*r, "other") for r in rows], PAGES + ", payload string").repartition(2), path, least=10, date="2020-01-02T03:04:05Z", archive_bytes=4096)
    back = warc.read_records(spark, path).collect()
    assert len(back) == len(rows) and len({r.archive for r in back}) > 4
    with open(back[0].archive.removeprefix("file://"), "rb") as f:
        first = f.read(12)
    assert struct.unpack("<I", first[:4])[0] == warc.FRAME_MAGIC  # too few records to train on
    html = {t or "" for _, _, t in rows}
    assert {bytes(r.payload).decode() for r in back if r.record_type == "response"} == html and all(r.payload is None for r in back if r.record_type == "revisit")
    assert {r.record_id for r in back if r.payload_length == 0 and r.record_type == "response"} == {"urn:page:200", "urn:page:201"}  # too short to be revisits
    assert {r.target_uri for r in back} >= {"http://h/a%20b%0D%0AX:%201", "é", None} and {r.date for r in back} == {"2020-01-02T03:04:05Z"}


def test_an_archive_begins_with_its_dictionary(spark):
    path = new_path(spark, "archives")
    rng = random.Random(5)
    warc.write_pages(spark.createDataFrame([(k, "u", " ".join(make_words(rng, 300))) for k in range(300)], PAGES).coalesce(1), path)
    rows = warc.read_records(spark, path).collect()
    with open(rows[0].archive.removeprefix("file://"), "rb") as f:
        data = f.read()
    assert struct.unpack("<I", data[:4])[0] == warc.DICTIONARY_MAGIC and len(rows) == 300
    assert len(data) < sum(r.content_length for r in rows) / 2


def test_archives_of_a_failed_job_stay_out(spark):
    from pyspark.sql import functions as F

    path = new_path(spark, "archives")
    df = spark.createDataFrame(pages(), PAGES).repartition(4)
    warc.write_pages(df, path)
    bad = df.withColumn("html", F.when(F.col("page_id") == 301, F.raise_error(F.lit("lost"))).otherwise(F.col("html")))
    with pytest.raises(Exception, match="lost"):
        warc.write_pages(bad, path)
    assert warc.read_records(spark, path, payloads=False).count() == len(pages())


def test_op11_empty(spark, write):
    d = write(spark, pages=([], PAGES))
    out = queries.op11_warc(spark, d)
    assert out.collect() == [] and out.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def archive(records, dictionary=b"", packed=True):
    c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    head = b""
    if dictionary:
        data = zstandard.compress(dictionary) if packed else dictionary
        head = struct.pack("<II", warc.DICTIONARY_MAGIC, len(data)) + data
    return head + b"".join(c.compress(r) for r in records)


def good(k=1, text=b"payload"):
    return warc.record_bytes(k, "http://h/", text, warc.sha1(text), "response", None, "2020-01-01T00:00:00Z")


@pytest.mark.parametrize("packed", [True, False])
def test_dictionaries_of_both_kinds(packed):
    records = [good(k, (" ".join(make_words(random.Random(k), 200))).encode()) for k in range(200)]
    d = warc.trained(records)
    assert d and list(warc.frames(io.BytesIO(archive(records, d, packed)))) == records
    without = archive(records, d, packed)[8 + len(zstandard.compress(d) if packed else d) :]
    with pytest.raises(zstandard.ZstdError):
        list(warc.frames(io.BytesIO(without)))


def test_frames_are_skipped_and_cut_ones_refused():
    skip = struct.pack("<II", 0x184D2A51, 3) + b"abc"
    data = skip + archive([good()]) + skip + archive([good(2)])
    assert list(warc.frames(io.BytesIO(data))) == [good(), good(2)]
    for bad in (data[:-1], data[:-20], data + b"\x28", data + b"12345678", skip[:-1]):
        with pytest.raises(ValueError, match="archive ends|no Zstandard"):
            list(warc.frames(io.BytesIO(bad)))


BROKEN = {
    "no WARC header": good().replace(b"WARC/1.1", b"WARC/9.9", 1),
    "Content-Length is no number": re.sub(rb"(\r\nContent-Length: )\d+(\r\n\r\nHTTP)", rb"\1-5\2", good()),
    "the block has": good()[:-8],
    "doesn't end where": good() + b"x",
    "no WARC-Date": re.sub(rb"WARC-Date:[^\r]*\r\n", b"", good()),
    "stands twice": good().replace(b"WARC-Date", b"WARC-Type: response\r\nWARC-Date", 1),
    "no header line": good().replace(b"WARC-Date", b"odd\r\nWARC-Date", 1),
    "block has another digest": good().replace(b"payload\r\n", b"PAYLOAD\r\n"),
    "payload has another digest": re.sub(rb"WARC-Block-Digest:[^\r]*\r\n", b"", good()).replace(b"payload\r\n", b"PAYLOAD\r\n"),
    "HTTP header says": re.sub(rb"WARC-Block-Digest:[^\r]*\r\n", b"", good()).replace(b"Content-Length: 7", b"Content-Length: 8"),
}


@pytest.mark.parametrize("message", BROKEN)
def test_broken_records_are_refused(message):
    assert BROKEN[message] != good()
    with pytest.raises(ValueError, match=message):
        warc.parsed(BROKEN[message])


def test_broken_records_are_kept_on_demand(spark, tmp_path):
    (tmp_path / "a.warc.zst").write_bytes(archive([good(1), good(2)[:-1], b"", good(3)]))
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "b.warc.zst").write_bytes(archive([good(9)]))
    rows = warc.read_records(spark, str(tmp_path), keep_bad=True).orderBy("number").collect()
    assert [(r.number, r.record_id, r.problem is None) for r in rows] == [(0, "urn:page:1", True), (1, None, False), (2, None, False), (3, "urn:page:3", True)]
    with pytest.raises(Exception, match="record 1 of"):
        warc.read_records(spark, str(tmp_path)).collect()


def test_other_writers_records():
    folded = b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-RECORD-ID: <urn:x:1>\r\nWARC-Date: 2020\r\nX-Long: a\r\n b\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    row = warc.parsed(folded)
    assert (row["record_type"], row["record_id"], row["payload"], row["content_length"], row["payload_digest"]) == ("warcinfo", "urn:x:1", b"ab", 2, None)


# --- search ------------------------------------------------------------------------------------------------------


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def ranked(docs, items, top=50):
    own = [(d, Counter(terms(t))) for d, t in docs]
    n, total = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in own:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def searched(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def library():
    rng = random.Random(11)
    lexicon = make_words(rng, 60) + ["Ünïcode", "ABC", "x1", "l’eau"]
    docs = [(k, " ".join(rng.choices(lexicon, k=rng.randint(0, 40)))) for k in range(150)]
    docs += [(7, docs[7][1]), (None, docs[3][1]), (None, None), (500, None), (501, ""), (502, "...!"), (503, "x1 " * 70_000), (504, "the"), (505, docs[5][1])]
    items = [(k, " ".join(rng.choices(lexicon, k=rng.randint(1, 12)))) for k in range(12)]
    items += [(3, "x1 X1 abc"), (None, "abc, ünïcode"), (90, None), (91, ""), (92, "neverseen"), (93, "the")]
    return docs, items


@pytest.mark.parametrize("lane, bundle", [(2048, 256), (7, 3)])
def test_op12_matches_brute_force(spark, library, monkeypatch, lane, bundle):
    monkeypatch.setattr(ranked_search, "LANE", lane)
    monkeypatch.setattr(ranked_search, "BUNDLE", bundle)
    docs, items = (spark.createDataFrame(rows, schema) for rows, schema in zip(library, (DOCS, ITEMS), strict=True))
    assert searched(ranked_search.search(docs.repartition(3), items)) == ranked(*library)
    assert searched(ranked_search.search(docs, items.repartition(2), 3)) == ranked(*library, top=3)


def test_op12_with_large_vocabularies_and_indexes(spark, library, monkeypatch):
    monkeypatch.setattr(ranked_search, "MOST_TERMS", 0)
    monkeypatch.setattr(ranked_search, "MOST_INDEX", 0)
    monkeypatch.setattr(ranked_search, "LANE", 16)
    docs, items = (spark.createDataFrame(rows, schema) for rows, schema in zip(library, (DOCS, ITEMS), strict=True))
    assert searched(ranked_search.search(docs, items)) == ranked(*library)


def test_op12_clashing_columns_and_none(spark, write):
    more = spark.createDataFrame([(1, "a b", 5, 6, 7)], DOCS + ", item_id int, score long, term int")
    items = spark.createDataFrame([(1, "b", 5)], ITEMS + ", doc_id int")
    assert searched(ranked_search.search(more, items)) == ranked([(1, "a b")], [(1, "b")])
    for docs, asked in (([], [(1, "a")]), ([(1, "a")], []), ([], [])):
        assert searched(queries.op12_ranked_search(spark, write(spark, documents=(docs, DOCS), benchmark=(asked, ITEMS)))) == []


def test_op12_owners_share_the_terms():
    assert len({zlib.crc32(t.encode()) % ranked_search.STAGES for t in make_words(random.Random(1), 200)}) == ranked_search.STAGES


# --- whitening ---------------------------------------------------------------------------------------------------


def whitened(rows, most=16):
    """(vec_id, component, n, deviation, |whitened|, explained) by numpy, for vectors of one length."""
    sound = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in sound], np.int64)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    a = (n * u - s) / n
    e, q = np.linalg.eigh(a.T @ a / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(most, int((e > len(e) * np.finfo(float).eps * e[0]).sum()))
    z = ((n * x - s) / n) @ q[:, :k] / np.sqrt(e[:k])
    return {"z": z, "n": n, "deviation": ((n * x - s) ** 2).sum(1), "explained": e[:k] / e.sum(), "ids": [i for i, _ in sound], "e": e}


def compare(got, want, tolerance=1e-9):
    k = want["z"].shape[1]
    assert len(got) == len(want["ids"]) * k
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), []).append(r)
    z = []
    for i, d in zip(want["ids"], want["deviation"].tolist(), strict=True):
        rows = {r.component: r for r in by[i, d]}
        assert sorted(rows) == list(range(1, k + 1)) and {r.n for r in rows.values()} == {want["n"]}
        assert np.allclose([rows[c].explained for c in sorted(rows)], want["explained"], rtol=1e-9)
        assert max(r.identity_error for r in rows.values()) < 1e-9
        z.append([rows[c].whitened for c in sorted(rows)])
    z = np.array(z)
    assert np.abs(z * np.sign((z * want["z"]).sum(0)) - want["z"]).max() < tolerance


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    return [(k, (rng.normal(size=d) * np.linspace(2, 0.3, d)).tolist()) for k in range(n)]


def test_op13_matches_numpy(spark, write):
    rows = vectors(120, 20, 1)
    rows += [(500, None), (501, [None] + [0.0] * 19), (502, [float("nan")] + [0.0] * 19), (503, [float("inf")] + [0.0] * 19), (None, rows[5][1]), (7, rows[7][1]), (600, rows[0][1]), (601, [0.0] * 20)]
    d = write(spark, embeddings=([(*r, 1) for r in rows], VECTORS))
    compare(queries.op13_whitening(spark, d).collect(), whitened(rows))


def test_op13_adds_up_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 7)
    monkeypatch.setattr(whitening, "FANIN", 2)
    rows = vectors(90, 6, 2)
    compare(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5), 4).collect(), whitened(rows, 4))


def test_op13_of_few_dimensions_equal_eigenvalues_and_lengths(spark):
    line = [(k, [k * 1.0, 2.0 * k, 0.0]) for k in range(10)]  # one dimension of three
    got = whitening.whiten(spark.createDataFrame(line, "vec_id long, embedding array<double>")).collect()
    compare(got, whitened(line))
    assert len(got) == 10
    corners = [(k, [float(b) for b in f"{k:04b}"]) for k in range(16)]  # four equal eigenvalues
    got = whitening.whiten(spark.createDataFrame(corners, "vec_id long, embedding array<double>")).collect()
    z = np.zeros((16, 4))
    for r in got:
        z[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(z.T @ z / 16, np.eye(4)) and np.allclose([r.explained for r in got], 0.25)
    mixed = [*line, (50, []), (51, [1.0]), *((60 + k, v) for k, v in vectors(30, 5, 3))]
    got = whitening.whiten(spark.createDataFrame(mixed, "vec_id long, embedding array<float>")).collect()
    compare([r for r in got if r.vec_id < 50], whitened(line))
    compare([r for r in got if r.vec_id >= 60], whitened([r for r in mixed if r[0] >= 60]))
    assert not [r for r in got if r.vec_id in (50, 51)]


def test_op13_of_far_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [-3e37, 1.0]), (3, [0.5, 2.0]), (4, [0.25, -1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.vec_id, r.deviation is None) for r in got} == {(1, True), (2, True), (3, False), (4, False)} and all(math.isfinite(r.whitened) for r in got)


def test_op13_empty_and_alike(spark, write):
    assert queries.op13_whitening(spark, write(spark, embeddings=([], VECTORS))).collect() == []
    assert queries.op13_whitening(spark, write(spark, embeddings=([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], VECTORS))).collect() == []


def test_bidiagonal_form(spark):
    rows = vectors(50, 8, 4)
    blocks = whitening.blocks_of(whitening.whole_numbers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))).persist()
    x = np.concatenate([np.frombuffer(bytes(r.x), np.int64).reshape(-1, 8) for r in blocks.collect()])
    b, v = whitening.bidiagonal(whitening.Table(blocks, 8, len(x), x.sum(0)))
    a = (len(x) * x - x.sum(0)) / len(x)
    assert np.allclose(np.triu(np.tril(b, 1)), b) and np.allclose(v.T @ v, np.eye(8), atol=1e-12)
    u = a @ v @ np.linalg.inv(b)
    assert np.allclose(u.T @ u, np.eye(8), atol=1e-9)
    blocks.unpersist()
