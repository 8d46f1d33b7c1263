import random

import pytest

SYL = "ka lo mi ren tos vel nu dar pi sho wen ul".split()


@pytest.fixture(scope="session")
def write(tmp_path_factory):
    """Writes tables (name -> (rows, schema)) as Parquet and gives the folder."""

    def make(spark, **tables) -> str:
        d = tmp_path_factory.mktemp("tables")
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
        return str(d)

    return make


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(SYL, k=rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with copies, near copies, chains of edits, shared passages, nulls, empty and short texts, a long one."""
    rng = random.Random(7)
    base = [words(rng, rng.randint(1, 160)) for _ in range(60)]
    passage = words(rng, 70)
    texts: list = [" ".join(w) for w in base]
    for w in base[:20]:
        texts += [" ".join(w), " ".join(w).upper()]
        now = list(w)
        for _ in range(4):
            now[rng.randrange(len(now))] = "edit"
            texts.append("\n".join(now))
    for w in base[20:40]:
        texts.append(" ".join(w[: len(w) // 2] + passage + w[len(w) // 2 :]))
    texts += [None, "", "  \t\n", "one", "one two three", "ONE two  three", " ".join(words(rng, 5000)), "é " * 60, "  a\x1cb " * 30]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(3 * i + 1, texts[k]) for i, k in enumerate(order)]


DOCS = "doc_id long, text string"
