import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, bucket int, row string, node long, key int, block int, tile int, epoch int"


def corpus() -> list[tuple]:
    """Small awkward corpus: copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(1, 7))) for _ in range(400)]

    def words(n: int) -> list[str]:
        return [r.choice(vocabulary) for _ in range(n)]

    texts: list[str | None] = [None, "", " \t\n ", "one", "Two words", "two WORDS"]
    base, passage = words(120), words(40)
    texts.append(" ".join(base))
    texts.append("  ".join(base).upper())
    texts += [" ".join(base)] * 3
    for change in (1, 2, 4, 8, 16):
        near = list(base)
        for i in range(change):
            near[(i * 29 + 5) % len(near)] = "changed" + str(change) + str(i)
        texts.append(" ".join(near))
    for i in range(4):
        texts.append(" ".join(words(20 + i) + passage + words(15)) + "\n" + " ".join(passage[:12]))
    texts.append(" ".join(words(6000)))
    texts.append("same " * 300)
    texts.append("same " * 40)
    texts.append("Ünï çode wörds ÉÀ Éà   x y " + " ".join(words(20)))
    texts += [" ".join(words(r.randint(5, 60))) for _ in range(25)]
    rows = [(i * 3 % 101 if i else 0, t, ["en", "de", None][i % 3], ["big", "big", "mid", None, "small"][i % 5], len(t or ""), 1.0, 1, "r", 1, 1, 1, 1, 1) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6]]  # repeated rows
    rows += [(None, " ".join(base), "en", "big", 5, 0.0, 0, "r", 0, 0, 0, 0, 0), (None, None, None, None, None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return corpus()
