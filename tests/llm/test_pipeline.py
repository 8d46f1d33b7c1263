"""The stages of the corpus pipeline against brute force, and their cases."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string"
COLUMNS = DOCS + ", lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def alike(a, b):
    return bool(a) and 100 * len(a & b) >= 80 * len(a | b)


def survivors(rows):
    """(id, text) of rows that stay: one of each component, those with the smallest id; rows without words; of rows without an id one of each set."""
    named = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in named}
    changed = True
    while changed:
        changed = False
        for a, x in named:
            for b, y in named:
                low = min(root[a], root[b])
                if (a == b or alike(x, y)) and (root[a], root[b]) != (low, low):
                    root[a] = root[b] = low
                    changed = True
    out, seen = [], set()
    for i, t in rows:
        s = frozenset(shingles(t))
        if i is None:
            if not s or (s not in seen and s not in [frozenset(x) for _, x in named]):
                out.append((i, s))
                seen.add(s)
        elif root[i] == i and (not s or (i, s) not in seen):
            out.append((i, s))
            seen.add((i, s))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def odd(corpus):
    rows = corpus + corpus[:4] + [(None, corpus[5][1]), (None, "ka lo mi ren tos vel only here"), (None, "KA lo mi ren tos vel only here"), (None, None), (None, ""), (9000, corpus[0][1]), (9001, "x " * 60_000)]
    return [(i, t, None, "s", len(t or "")) for i, t in rows]


def test_near_duplicates_against_brute_force(spark, odd):
    import corpus_pipeline

    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(odd, COLUMNS), "").collect()
    assert sorted(((r.doc_id, frozenset(shingles(r.text))) for r in got), key=str) == survivors([(r[0], r[1]) for r in odd])
    assert set(map(tuple, got)) <= set(odd)


def test_contaminated_documents_against_brute_force(spark, write, odd):
    import corpus_pipeline

    long = max((r[1] for r in odd if r[1] and "x x" not in r[1]), key=len).split()
    items = [(1, " ".join(long[20:40])), (2, None), (3, " "), (4, "one two three"), (None, odd[0][1]), (5, " ".join(long[50:57]))]
    d = write(spark, benchmark=(items, "item_id long, text string"))
    sets = [s for i, t in items if i is not None and (s := shingles(t))]
    got = corpus_pipeline.drop_contaminated(spark, spark.createDataFrame(odd, COLUMNS), d).collect()
    want = [r for r in odd if not any(10 * len(s & shingles(r[1])) >= 8 * len(s) for s in sets)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(want) < len(odd)


def test_masked_texts_and_their_lengths(spark):
    import corpus_pipeline

    rows = [(1, "mail me@ka.org or 10.0.0.1", "en", "s", 26), (1, "mail me@ka.org or 10.0.0.1", "en", "s", 26), (None, None, None, None, None), (2, "", "", "", 0), (3, "ka " * 50_000 + "me@ka.org", "en", "s", 1)]
    got = corpus_pipeline.mask_personal_data(spark, spark.createDataFrame(rows, COLUMNS), "").collect()
    want = [(1, "mail [EMAIL] or [IP]", "en", "s", 20)] * 2 + [(None, None, None, None, None), (2, "", "", "", 0), (3, "ka " * 50_000 + "[EMAIL]", "en", "s", 150_007)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_packed_rows_against_the_library(spark, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline

    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = corpus_pipeline.pack(spark, spark.createDataFrame(odd, COLUMNS), "").collect()
    want = []
    for i, t, *_ in odd:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, k, at, len(p := ids[at : at + 4096]), zlib.crc32(np.array(p, "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_toxic_documents_go_and_others_keep_their_columns(spark, write):
    import corpus_pipeline

    rng = random.Random(2)
    text = lambda n: " ".join("".join(rng.choices("ka lo mi ren tos vel".split(), k=2)) for _ in range(n))
    clash = "_id string, score string, toxic string, node string, h string"
    rows = [(i, text(30) + (" zorble ha zorble" if i % 6 == 0 else ""), *[str(i)] * 5) for i in range(400)]
    rows += [(None, None, *["x"] * 5), (None, "", *["x"] * 5), (900, text(40_000), *["x"] * 5), (901, text(40_000) + " zorble ha zorble", *["x"] * 5), (0, rows[0][1], *["x"] * 5)]
    d = write(spark, labels=([(i, 1, int(i % 6 == 0)) for i in range(300)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int"))
    docs = spark.createDataFrame(rows, f"{DOCS}, {clash}")
    got = corpus_pipeline.drop_toxic(spark, docs, d)
    assert got.columns == docs.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(r) for r in rows if "zorble" not in (r[1] or ""))


@pytest.mark.parametrize("stage", range(5))
def test_stages_with_clashing_columns_and_none(spark, write, stage):
    import corpus_pipeline

    names = "n h key score bytes doc rank spans shard words node root _row _id _text pii _h n_shingles component_id pivot".split()
    schema = DOCS + ", " + ", ".join(f"{x} string" for x in names)
    d = write(spark, labels=([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int"), benchmark=([(1, "p q r s t u")], "item_id long, text string"))
    own = corpus_pipeline.STAGES[stage][1]
    rows = [(1, "a b c d e f", *names), (2, None, *names), (2, None, *names), (3, "", *names)]
    got = own(spark, spark.createDataFrame(rows, schema), d)
    assert got.count() == 4
    if stage < 4:
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rows)) and got.columns == ["doc_id", "text", *names]
    assert own(spark, spark.createDataFrame([], schema), d).count() == 0


def test_pipeline_keeps_clean_and_drops_planted(spark, write):
    import corpus_pipeline

    rng = random.Random(4)
    syl = "ka lo mi ren tos vel nu dar pi sho".split()
    text = lambda n: " ".join("".join(rng.choices(syl, k=rng.randint(1, 3))) for _ in range(n))
    clean = [text(60) for _ in range(60)]
    item = text(30)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean)]
    rows += [(100, clean[0], "en", "s", 1), (101, clean[1] + " edit", "en", "s", 1), (102, text(20) + " " + item + " " + text(20), "en", "s", 1), (103, text(30) + " mail me@ka.org", "en", "s", 1)]
    rows += [(200 + i, text(30) + " zorble " + text(9) + " zorble", "en", "s", 1) for i in range(12)]
    labels = [(i, 1, 0) for i in range(60)] + [(200 + i, 0, 1) for i in range(10)]
    d = write(spark, documents=(rows, DOCS + ", lang string, source string, n_chars long"), labels=(labels, "doc_id long, quality int, toxic int"), benchmark=([(1, item)], "item_id long, text string"))
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert kept[0] == set(range(60)) | {100, 101, 102, 103}
    assert kept[1] == kept[0] - {100, 101} and kept[2] == kept[1] - {102} and kept[3] == kept[2]
    assert docs.where(F.col("doc_id") == 103).first().text.endswith("mail [EMAIL]")
    assert {r.doc_id for r in corpus_pipeline.run(spark, d).collect()} == kept[3]


def test_tables_made_on_the_way_are_deleted(spark):
    from cadenza.llm import scratch

    def make():
        scratch.release(scratch.materialize(spark.range(3)))
        return scratch.materialize(spark.range(5)).join(scratch.materialize(spark.range(2, 9)), "id")

    held = list(scratch._WRITTEN)
    out = scratch.written_once(make)
    assert [w for w in scratch._WRITTEN if w not in held] == [(spark, out.__dict__["_written"])] and out.count() == 3
    scratch.release(out)
    assert scratch._WRITTEN == held
