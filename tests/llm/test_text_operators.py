"""Operators over documents against brute force, and their edge cases."""

import hashlib
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import decontaminate, graph, jaccard, packing, pii, queries, scratch, shards, token_counts

DOCS = "doc_id long, text string"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def classes(rows):
    sets, u = {d: shingles(t) for d, t in rows}, Union()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                u.join(a, b)
    return {d: (len(s), u.find(d)) for d, s in sets.items()}


@pytest.fixture(scope="module")
def docs_dir(spark, write, corpus):
    return write(spark, documents=(corpus, DOCS), benchmark=([], "item_id long, text string"), labels=([], "doc_id long, quality int, toxic int"))


def test_op3_matches_brute_force(spark, docs_dir, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_jaccard_join(spark, docs_dir).collect()}
    assert got == classes(corpus)


def test_op3_rounds_of_large_regions(spark, docs_dir, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "REGION_NODES", 0)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_jaccard_join(spark, docs_dir).collect()}
    assert got == classes(corpus)


def test_sketches_bound_the_difference(corpus):
    from cadenza.llm.words import shingle_sets
    import pyarrow as pa

    sets = [s for _, s in shingle_sets(pa.array([t for _, t in corpus], pa.string()))]
    for x in sets[::5]:
        for y in sets[::7]:
            assert jaccard.apart(jaccard.sketch(x), jaccard.sketch(y)) <= len(np.setxor1d(x, y))


def test_words_of_long_texts_do_not_depend_on_blocks(corpus, monkeypatch):
    import pyarrow as pa

    from cadenza.llm import words

    texts = pa.array([t for _, t in corpus] + ["y" * 3000 + " z  " * 900, None, " "], pa.string())
    want = [(i, s.tolist()) for i, s in words.shingle_sets(texts)]
    assert [len(s) for _, s in want] == [len(shingles(t)) for t in texts.to_pylist()]
    for block in (64, 1000):
        monkeypatch.setattr(words, "BLOCK", block)
        monkeypatch.setattr(words, "_POWERS", [])
        assert [(i, s.tolist()) for i, s in words.shingle_sets(texts)] == want


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    u = Union()
    for a, b in links:
        u.join(a, b)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: u.find(x) for x in list(u) if x in got} and len(got) == 41 + 30 + 3


def test_op5_matches_brute_force(spark, docs_dir, corpus):
    own = {d: WORD.findall(t or "") for d, t in corpus}
    first = {}
    for d in sorted(own):
        for i in range(len(own[d]) - 49):
            first.setdefault(tuple(own[d][i : i + 50]), d)
    want = {}
    for d, w in own.items():
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone[i : i + 50] = [True] * 50
        want[d] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op5_substring_dedup(spark, docs_dir).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 500


def test_bitmap_has_all_and_few_others(spark, monkeypatch):
    from cadenza.llm import bloom

    rng = np.random.default_rng(3)
    own, others = (rng.integers(-(2**63), 2**63 - 1, 3000) for _ in range(2))
    df = spark.createDataFrame([(int(x),) for x in own], "h long")
    bitmap = bloom.of(df, "h")
    assert bloom.within(bitmap, own).all() and bloom.within(bitmap, others).mean() < 0.1
    monkeypatch.setattr(bloom, "MOST", 10)  # too small a bitmap lets more through, and still all of its own
    assert bloom.within(bloom.of(df, "h"), own).all()
    assert not bloom.within(bloom.of(df.where("false"), "h"), own).any()


def test_intervals_merge_over_batches():
    import pyarrow as pa

    from cadenza.llm import substrings

    rng = np.random.default_rng(6)
    rows = sorted((int(d), int(a), int(a + n)) for d, a, n in zip(rng.integers(-3, 4, 200), rng.integers(0, 300, 200), rng.integers(1, 30, 200)))
    want = {d: {w for e, a, b in rows if e == d for w in range(a, b)} for d, *_ in rows}
    for size in (1, 7, 200):
        parts = [rows[k : k + size] for k in range(0, 200, size)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in p], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], names=["doc", "start", "stop"]) for p in parts]
        got = [tuple(r.values()) for b in substrings._merge(iter(batches)) for r in b.to_pylist()]
        assert all(a[0] < b[0] or a[0] == b[0] and a[2] < b[1] for a, b in zip(got, got[1:]))
        assert {d: {w for e, a, b in got if e == d for w in range(a, b)} for d in want} == want


def test_op5_splits_common_routes(spark, docs_dir, monkeypatch, corpus):
    from cadenza.llm import substrings

    want = sorted(map(tuple, queries.op5_substring_dedup(spark, docs_dir).collect()), key=str)
    monkeypatch.setattr(substrings, "COMMON", 0)  # every route
    assert sorted(map(tuple, queries.op5_substring_dedup(spark, docs_dir).collect()), key=str) == want


def test_a_route_of_many_windows_is_settled_in_parts(monkeypatch):
    from cadenza.llm import substrings

    rng = np.random.default_rng(6)
    doc = rng.permutation(np.arange(3000))
    keys = rng.integers(0, 40, 3000).astype(np.uint64)
    batches = [substrings._sent(np.full(n, 5, np.uint64), doc[a : a + n], np.zeros(n, np.int64), keys[a : a + n]) for a, n in ((k, 100) for k in range(0, 3000, 100))]
    want = {int(d) for d, k in zip(doc, keys, strict=True) if d > doc[keys == k].min()}
    held, repeats = [], substrings._repeats
    monkeypatch.setattr(substrings, "WINDOWS", 64)
    monkeypatch.setattr(substrings, "_repeats", lambda key, d: held.append(len(key)) or repeats(key, d))
    got = [d for b in substrings._compare(iter(batches)) for d in b.column(0).to_pylist()]
    assert sorted(got) == sorted(want) and max(held) <= 256


def test_op5_with_small_blocks(spark, docs_dir, monkeypatch):
    from cadenza.llm import substrings

    want = {r.doc_id: r.kept_sha256 for r in queries.op5_substring_dedup(spark, docs_dir).collect()}
    monkeypatch.setattr(substrings, "WINDOWS", 64)
    assert {r.doc_id: r.kept_sha256 for r in queries.op5_substring_dedup(spark, docs_dir).collect()} == want


def luhn(s):
    return sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(s)))) % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
]


def personal(text):
    spans, n = [], [0] * 4
    for k, (_, pattern, ok) in enumerate(KINDS):
        for m in re.finditer(pattern, text or ""):
            if ok(m[0]):
                spans.append((m.start(), k, m.end()))
                n[k] += 1
    listed = ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*n, hashlib.sha256(listed.encode()).hexdigest())


def test_op1_matches_brute_force(spark, write):
    import random

    rng = random.Random(5)
    parts = list("0123456789") * 3 + list(" .-+()@ab_%") + ["\u0001", "é", "@.", "192.168.1.1", "4111 1111 1111 1111", "+1 (202) 555-0143", "a@b.co", "\u0002", "🙂"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(1500)] + [None, "", "a" * 100000, "1" * 50000, "1." * 9000, "+" * 500, "a@" * 5000]
    d = write(spark, documents=(list(enumerate(texts)), DOCS))
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in queries.op1_pii(spark, d).collect()}
    assert got == {i: personal(t) for i, t in enumerate(texts)}


def test_pii_checksums_context_and_masks(spark):
    rows = [(1, "iban GB82 WEST 1234 5698 7654 32 and GB83 WEST 1234 5698 7654 32", "x"), (2, "call tel 030 1234567 now, not 030 1234567890123456789", "y"), (3, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    out = {r.doc_id: r for r in pii.redact(df).collect()}
    assert out[1].text == "iban [IBAN] and GB83 WEST 1234 5698 7654 32" and out[1].pii == "x"
    assert out[2].text.startswith("call tel [LOCAL] now") and out[3].text is None


def test_op1_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a@b.co", "x", 2, 3)], "doc_id long, text string, _text string, _email int, `_row` int")
    row = pii.find_pii(df).first()
    assert tuple(row)[:5] == (1, "a@b.co", "x", 2, 3) and len(row.pii) == 1


def test_op1_added_kinds(spark, write):
    secret = hashlib.sha1(b"x").hexdigest()
    texts = {
        1: ("DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", ["iban:0:27"]),
        2: ("pay DE89370400440532013000 EUR 50, not DE88370400440532013000", ["iban:4:26"]),
        3: ("NO93 8601 1117 947 A", ["iban:0:18"]),
        4: (f'token = "{secret}"', ["secret:9:49"]),
        5: (f"commit {secret} by us", []),
        6: ("the key " + "ab1" * 14 + " and the keyboard " + secret, []),
        7: (f"my monkey {secret}", []),
        8: (f"API_KEY: {secret[:20]}==", ["secret:9:31"]),
        9: (f"key {secret * 5}", ["secret:4:204"]),
        10: (f"API_KEY={secret}", ["secret:8:48"]),
        11: (f"https://h/?key={secret}&x=1", ["secret:15:55"]),
        12: (f"SCHLÜSSEL: {secret}, CLÉ:{secret}", ["secret:11:51", "secret:57:97"]),
        13: (f"token {secret}=x and key {secret}===", []),
        14: ("phone_number: 030 123 4567", ["local:14:26"]),
        15: ("tel1: 030 123 4567, MÓVIL 030 123 4567", ["local:6:18", "local:26:38"]),
    }
    d = write(spark, documents=([(i, t) for i, (t, _) in texts.items()], DOCS))
    rows = queries.op1_pii(spark, d).collect()
    assert all(r.n_spans == sum(1 for x in r.spans.split(",") if x) for r in rows)
    got = {r.doc_id: [x for x in r.spans.split(",") if x.split(":")[0] in ("iban", "secret", "local")] for r in rows}
    assert got == {i: x for i, (_, x) in texts.items()}


def test_op2_laws(spark, docs_dir, corpus):
    rows = queries.op2_sharding(spark, docs_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in corpus)
    text, size, where, slots = dict(corpus), defaultdict(int), {}, defaultdict(list)
    for r in rows:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert where.setdefault(raw, r.shard) == r.shard
    assert set(size) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op2_bytes_are_near_equal(spark, write):
    rng = np.random.default_rng(4)
    texts = ["x" * n + str(i % 2500) for i, n in enumerate(rng.integers(1, 400, 2500))]
    rows = list(enumerate(texts + texts[:500] + texts[:1] * 40))
    size, mean = defaultdict(int), sum(len(t) + 8 for _, t in rows) / 24
    for r in queries.op2_sharding(spark, write(spark, documents=(rows, DOCS))).collect():
        assert r.law == "bytes" and r.grown_shard is None
        size[r.shard] += r.size
    assert len(size) == 24 and max(size.values()) - min(size.values()) <= 0.001 * mean


def test_differencing_is_tight_and_whole():
    rng = np.random.default_rng(1)
    for n, k in ((1, 4), (3, 4), (200, 4), (500, 24)):
        sums = np.zeros((n, k), np.int64)
        sums[:, 0] = rng.integers(1, 1000, n)
        place, total = shards.difference(sums)
        back = np.zeros(k, np.int64)
        np.add.at(back, place[:, 0], sums[:, 0])
        assert (np.sort(back) == np.sort(total)).all() and (np.sort(place, 1) == np.arange(k)).all()
    assert total.max() - total.min() < 20


def test_sharding_over_levels(spark, monkeypatch):
    monkeypatch.setattr(shards, "CELL", 5)
    monkeypatch.setattr(shards, "FAN", 3)
    monkeypatch.setattr(shards, "LANE", 20)
    df = spark.createDataFrame([(i, "x" * (i % 37) + str(i % 90)) for i in range(300)], DOCS)
    rows = shards.shard_documents(df, 6).collect()
    size = defaultdict(int)
    for r in rows:
        size[r.shard] += r.size
    assert len(rows) == 300 and max(size.values()) - min(size.values()) < 60
    for s in range(6):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


ODD = ["", " ", "  ", "a  b", " a ", "a\n b\t　c  ", "x▁y ▁", "<s> </s> <unk> <0x41>", "🙂 🙂🙂  ", "a" * 3000, "\x00 \x00a", "e ́x", "<|endoftext|> x", "ΑΣ ΣΑΣ", "İstanbul I'LL'S", "a\x1cb\xa0c d \x85e", "ﬁ½²", "don't  'S"]


def test_token_counts_are_the_library_s(spark, write, corpus):
    import public_tokenizers
    import sentencepiece

    texts = ODD + [t for _, t in corpus]
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    d = write(spark, documents=(list(enumerate(texts)), DOCS))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op9_token_counts(spark, d).collect()}
    n = [len(x) for x in lib.encode([t or "" for t in texts])]
    assert got == {i: (len((t or "").encode()), k, k > 4096) for i, (t, k) in enumerate(zip(texts, n))}


def test_caches_turn_over(monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    texts = [" ".join(f"w{i % 20}x{j} é{i}!" for j in range(9)) + " " * (i % 3) for i in range(30)] * 2 + ["x" * 9000 + " y" * 5000, None, "end"]
    monkeypatch.setattr(token_counts, "CACHE", 500)
    monkeypatch.setattr(token_counts, "BLOCK", 300)
    counter = token_counts.PieceCounter(public_tokenizers.path("piece_bpe_32k.model"))
    encoder = token_counts.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert counter.splits and encoder.splits
    for own in (counter, encoder):
        own.table = own.frequent(pa.array(texts[:4], pa.string()))
    for at in range(0, len(texts), 7):
        part = [t or "" for t in texts[at : at + 7]]
        column = pa.array(texts[at : at + 7], pa.string())
        assert counter.count(column).tolist() == [len(x) for x in counter.lib.encode(part)]
        assert [x.tolist() for x in encoder.ids(column)] == [e.ids for e in encoder.lib.encode_batch(part, add_special_tokens=False)]


def test_compact_tables_compare_keys_whole():
    import pyarrow as pa

    words = [b"", b"a", b"abcdefgh", b"abcdefghi", b"abcdefghij" * 6, b"b"]
    keys = token_counts.Keys.of(pa.array(words, pa.binary()))
    table = token_counts.Table()
    table.add(keys, keys.hashes(), np.arange(6), np.arange(15))
    at = table.find(keys, keys.hashes())
    assert [table.numbers[f : f + n].tolist() for f, n in zip(table.first[at], table.count[at])] == [[], [0], [1, 2], [3, 4, 5], [6, 7, 8, 9], [10, 11, 12, 13, 14]]
    other = token_counts.Keys.of(pa.array([b"c", b"x", b"abcdefgX", b"abcdefghX", b"abcdefghij" * 5 + b"abcdefghiX", b"a"], pa.binary()))
    assert (table.find(other, keys.hashes())[:5] == -1).all()  # equal hashes, other keys


def test_op4_packs_every_piece(spark, write, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ODD + [t for _, t in corpus] + ["ka " * 4095, "ka " * 4096, "ka " * 9000]
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    d = write(spark, documents=(list(enumerate(texts)), DOCS))
    rows = queries.op4_packing(spark, d).collect()
    want = set()
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        want |= {(i, k, at, len(p := ids[at : at + 4096]), zlib.crc32(np.array(p, "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 4096))}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for seq in by.values():
        at = 0
        for offset, length in sorted(seq):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_the_driver_encodes_and_solves_nothing(spark, corpus, monkeypatch):
    """Its memory holds neither a vocabulary nor the program's fillings: both are made in tasks."""
    import public_tokenizers

    def fails(*_):
        raise AssertionError("in the driver")

    path, docs = public_tokenizers.path("word_bpe_49k.json"), spark.createDataFrame(corpus, DOCS)
    histogram = {int(r["length"]): r["count"] for r in packing.cut_documents(docs, path).groupBy("length").count().collect()}
    wanted = packing.places(packing.fillings(histogram)[0])
    n = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).agg(F.sum("n_tokens")).first()[0]
    for owner, name in ((token_counts.WordEncoder, "__init__"), (token_counts.PieceCounter, "__init__"), (packing, "cover"), (packing, "best_fit")):
        monkeypatch.setattr(owner, name, fails)
    got = packing.planned(spark, histogram)
    assert sorted(got) == sorted(wanted) and all((got[k] == wanted[k]).all() for k in wanted)
    assert packing.pack_documents(docs, path).count() == sum(histogram.values())
    assert token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).agg(F.sum("n_tokens")).first()[0] == n
    assert len(packing.planned(spark, {})["length"]) == 0


def test_scratch_tables_hold_no_file_of_the_driver(spark):
    df = scratch.materialize(spark.range(10).toDF("n"), "plain")
    folder = df.__dict__["_written"].removeprefix("file://").removeprefix("file:")
    files = os.listdir(folder)
    assert files and all(f.lstrip(".").startswith("part-") for f in files)
    assert sorted(r.n for r in df.collect()) == list(range(10))
    scratch.release(df)
    assert not os.path.exists(folder)


def test_fillings_use_each_piece_once():
    rng = np.random.default_rng(3)
    h = {int(k): int(v) for k, v in zip(*np.unique(np.clip(rng.lognormal(4, 1, 4000).astype(int), 1, 512), return_counts=True))}
    used = defaultdict(int)
    plan, given = packing.fillings(h, 512)
    for times, filling in plan:
        assert sum(k * v for k, v in filling.items()) <= 512
        for k, v in filling.items():
            used[k] += times * v
    assert used == h and sum(t for t, _ in plan) <= -(-sum(k * v for k, v in h.items()) // 512) + 2
    assert packing.fillings({}, 512) == ([], 0)
    placed = sum(t * sum(f.values()) for t, f in plan[:given])
    assert placed >= 0.9 * sum(h.values())


def test_the_program_places_most_pieces_at_any_size():
    rng = np.random.default_rng(5)
    lengths = np.clip(rng.lognormal(5.5, 1.2, 3000).astype(int), 1, 4095)
    for scale in (1, 100):
        h = {int(k): int(v) * scale for k, v in zip(*np.unique(lengths, return_counts=True))}
        plan, given = packing.fillings(h)
        assert sum(t * sum(f.values()) for t, f in plan[:given]) >= 0.9 * sum(h.values())
        assert sum(t for t, _ in plan) <= 1.001 * sum(k * v for k, v in h.items()) / 4096 + 1


@pytest.mark.parametrize("step", [37, 50, 100])
def test_the_program_packs_coarse_lengths(step):
    """Lengths whose sums never come near the limit: a filling is judged by what can be reached."""
    rng = np.random.default_rng(step)
    h = {int(k): int(v) for k, v in zip(*np.unique(np.clip(np.round(rng.lognormal(6.5, 1.2, 3000) / step), 1, 4000 // step).astype(int) * step, return_counts=True))}
    plan, given = packing.fillings(h)
    most = 4096 // step * step
    assert sum(t for t, _ in plan) <= 1.005 * sum(k * v for k, v in h.items()) / most + 1
    assert sum(t * sum(f.values()) for t, f in plan[:given]) >= 0.9 * sum(h.values())
    assert packing.reach(np.array([5, 7]), np.array([2, 1]), 20).tolist() == [0, 0, 0, 0, 0, 5, 5, 7, 7, 7, 10, 10, 12, 12, 12, 12, 12, 17, 17, 17, 17]


def test_bounded_knapsack_is_exact():
    import itertools

    rng = np.random.default_rng(8)
    for _ in range(20):
        lengths, most, price = np.sort(rng.choice(np.arange(1, 12), 4, replace=False)), rng.integers(1, 4, 4), rng.random(4)
        rooms = np.array([5, 17, 20])
        got = packing.priced(lengths, most, price, 20, rooms)
        for room, row in zip(rooms, got):
            best = max(float(np.dot(x, price)) for x in itertools.product(*(range(m + 1) for m in most)) if np.dot(x, lengths) <= room)
            assert (row <= most).all() and row @ lengths <= room and abs(float(row @ price) - best) < 1e-6


def test_op10_matches_brute_force(spark, write, corpus):
    texts = dict(corpus)
    long = max(texts.values(), key=lambda t: len(t or ""))
    w = long.split()
    items = [(1, " ".join(w[100:130])), (2, " ".join(w[200:230] + ["zz"] * 5)), (3, "one two three"), (4, None), (5, ""), (6, " ".join(w[300:310]).upper()), (7, " ".join(w[300:310]))]
    d = write(spark, documents=(corpus, DOCS), benchmark=(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in queries.op10_decontamination(spark, d).collect()}
    want = {}
    for i, t in items:
        q = shingles(t)
        for doc, text in corpus:
            n = len(q & shingles(text))
            if q and 10 * n >= 8 * len(q):
                want[doc, i] = (len(q), n)
    assert got == want and {i for _, i in want} >= {1, 3, 6, 7}
    left = {r.doc_id for r in decontaminate.clean(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")).collect()}
    assert left == set(texts) - {doc for doc, _ in want}


def test_op10_in_blocks_of_items(spark, monkeypatch, corpus):
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 2)
    docs, items = spark.createDataFrame(corpus, DOCS), spark.createDataFrame([(i, t) for i, t in corpus[:6]], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.containments(docs, items).collect()}
    assert {(i, i) for i, t in corpus[:6] if shingles(t)} <= got


def test_op10_finds_short_items_in_long_documents(spark, write):
    import random

    rng = random.Random(11)
    docs = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.choice([530, 1000, 4000])))) for i in range(40)]
    items, want = [], {}
    for i, t in docs:
        w = t.split()
        for n in (5, 6, 7, 8, 9, 14, 43, 44):
            at = rng.randrange(len(w) - n)
            want[i, len(items)] = (n - 4, n - 4)
            items.append((len(items), " ".join(w[at : at + n])))
    # Nine of eleven shingles, and one too few.
    w = docs[0][1].split()
    want[0, len(items)] = (11, 9)
    items += [(len(items), " ".join(w[50:63] + ["x", "y"])), (len(items) + 1, " ".join(w[50:62] + ["x", "y", "z"]))]
    d = write(spark, documents=(docs, DOCS), benchmark=(items, "item_id long, text string"))
    rows = queries.op10_decontamination(spark, d).collect()
    assert {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in rows} == want and len(rows) == len(want)
    assert decontaminate.clean(spark.createDataFrame(docs, DOCS), spark.createDataFrame([x for x in items if len(x[1].split()) == 5], "item_id long, text string")).count() == 0


def equals_its_sql(spark, name: str, *dirs: str) -> None:
    import duckdb

    for d in dirs:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "embeddings"):
            if os.path.exists(f"{d}/{t}.parquet"):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet{'/*.parquet' if os.path.isdir(f'{d}/{t}.parquet') else ''}')")
        df = queries.queries()[name](spark, d)
        want = con.execute(queries.oracle_sql()[name])
        assert [c[0] for c in want.description] == df.columns
        want = want.fetchall()
        assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want)) and want


def test_op10_equals_its_sql(spark, sf, write, corpus):
    rows = corpus + corpus[:3] + [(None, corpus[3][1])]
    items = [(i, " ".join((t or "").split()[3:12])) for i, t in corpus] + [(7, "one two  THREE"), (7, "one two three"), (None, "one two three"), (8, None), (9, " ")]
    equals_its_sql(spark, "op10_decontamination", sf, write(spark, documents=(rows, DOCS), benchmark=(items, "item_id long, text string")))


@pytest.mark.parametrize("name", ["op3_jaccard_join", "op5_substring_dedup"])
def test_text_operators_equal_their_sql(spark, sf, write, corpus, name):
    equals_its_sql(spark, name, sf, write(spark, documents=(corpus + corpus[:3], DOCS)))


def test_op1_equals_its_sql(spark, sf, write):
    key = hashlib.sha1(b"z").hexdigest()
    texts = [f"NAME_key={key}", f"key={key}=x token {key}=== pwd {key}==", f"SCHLÜSSEL: {key * 6}, CLÉ:{key}", "phone_number: 030 123 4567", "tel1: 030 123 4567, MÓVIL 030 123 4567", f"my_token_of_twenty_signs={key}", "call tel 030 1234567 now", "my token: " + "ab12cd34" * 4, "token = " + hashlib.sha1(b"y").hexdigest(), "DE89 3704 0044 0532 0130 00 BIC", "x@y.de,1.2.3.4 4111 1111 1111 1111 é +49 (30) 1234-567", None, ""]
    equals_its_sql(spark, "op1_pii", sf, write(spark, documents=([*enumerate(texts), (None, texts[0]), (1, texts[1])], DOCS)))


def test_op6_equals_its_sql(spark, sf):
    equals_its_sql(spark, "op6_embedding_dedup", sf)


@pytest.mark.parametrize("name", ["op1_pii", "op2_sharding", "op3_jaccard_join", "op4_packing", "op5_substring_dedup", "op8_toxicity", "op9_token_counts", "op10_decontamination", "pipeline"])
def test_empty_tables(spark, write, name):
    d = write(spark, documents=([], DOCS + ", lang string, source string, n_chars long"), benchmark=([], "item_id long, text string"), labels=([], "doc_id long, quality int, toxic int"))
    assert queries.queries()[name](spark, d).count() == 0


NULLS = ["op1_pii", "op2_sharding", "op3_jaccard_join", "op4_packing", "op5_substring_dedup", "op8_toxicity", "op9_token_counts", "pipeline"]


@pytest.mark.parametrize("name", NULLS)
def test_nulls_repeats_and_clashing_columns(spark, write, name):
    clash = "n long, h string, key string, score string, bytes string, doc string, rank string, spans string, shard string, words string, node string, root string"
    rows = [(i, t) + (None,) * 12 for i, t in [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (6, None), (7, "")]]
    d = write(spark, documents=(rows, f"{DOCS}, {clash}"), labels=([(5, 1, None), (None, 0, 1), (6, 0, 1), (7, 1, 0)], "doc_id long, quality int, toxic int"), benchmark=([(None, "x"), (1, None)], "item_id long, text string"))
    assert queries.queries()[name](spark, d).count() == (3 if name == "pipeline" else 5)


def test_op10_clashing_columns(spark, write):
    rows = [(None, "a b c d e f", "x", "y", "z"), (5, "A b c d e f", "x", "y", "z"), (5, "a b c d e f", "x", "y", "z"), (6, None, "x", "y", "z")]
    items = [(1, "b c d e f", 0, 0), (1, "b c d e f", 0, 0), (2, None, 0, 0), (None, "b c d e f", 0, 0)]
    d = write(spark, documents=(rows, f"{DOCS}, item_id string, n_item string, containment string"), benchmark=(items, "item_id long, text string, doc_id long, n_shared long"))
    got = sorted(map(str, map(tuple, queries.op10_decontamination(spark, d).collect())))
    assert got == sorted(map(str, [(i, 1, 1, 1, 1.0) for i in (None, 5, 5) for _ in range(2)]))
    left = decontaminate.clean(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")).collect()
    assert [tuple(r) for r in left] == [rows[3]]


def test_op7_clashing_columns(spark, write):
    rows = [(1, "u", "<article><p>One two three four.</p></article>", "t"), (1, "u", "<article><p>One two three four.</p></article>", "t"), (None, None, None, None)]
    d = write(spark, pages=(rows, "page_id long, url string, html string, text string"))
    assert sorted(map(str, map(tuple, queries.op7_html_text(spark, d).collect()))) == sorted(map(str, [(1, "u", "One two three four.", 19)] * 2 + [(None, None, "", 0)]))
