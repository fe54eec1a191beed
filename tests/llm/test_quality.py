import random

import pyarrow as pa
import pytest

from ledgerline.llm import quality


def corpus(n=400, seed=2):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(20, 120))]
        good = int(r.random() < 0.8)
        if not good:
            text = r.choice((lambda t: [w.upper() + "!!" for w in t], lambda t: [w + r.choice(("###", "$$$")) for w in t], lambda t: [t[0]] * len(t)))(text)
        rows.append((i, " ".join(text), good))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows if i % 5], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    held = [(got[i] >= 0.3, y) for i, _, y in rows if i % 5 == 0]
    assert sum(a == bool(y) for a, y in held) / len(held) >= 0.95
    assert all(0 <= s <= 1 for s in got.values())


def test_votes_are_exact_nearest_neighbours():
    """Scores equal those of a plain loop over all labelled vectors."""
    import numpy as np

    rows = corpus(120)
    table = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "quality": pa.array([r[2] for r in rows], pa.int32()), "weight": [1.0] * len(rows)})
    import pickle

    model = pickle.loads(quality._fit(table).column("model")[0].as_py())
    texts = [r[1] for r in corpus(30, seed=8)]
    got = quality.score_texts(model, pa.array(texts))
    for text, score in zip(texts, got, strict=True):
        v = quality._unit(quality.Terms(quality.word_block(pa.array([text]))).counts(0, 1) @ model["projection"])[0]
        near = sorted(((float(v @ u), i) for i, u in enumerate(model["vectors"])), reverse=True)[: quality.NEIGHBOURS]
        votes = [(max(s, 0) ** 4, model["labels"][i]) for s, i in near]
        assert score == pytest.approx(sum(w for w, y in votes if y) / sum(w for w, _ in votes), abs=1e-3)
    assert np.isfinite(got).all()


def test_awkward_rows(spark, docs, no_docs, rows):
    labels = spark.createDataFrame([(0, 1), (3, 1), (18, 0), (21, 0), (None, 1), (6, None), (9, 5), (18, 1), (9999, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    found = quality.score(docs, model, name="quality_score").collect()
    assert len(found) == len(rows) and all(0 <= r.quality_score <= 1 for r in found)
    assert {r.text for r in found} == {r[1] for r in rows}
    assert quality.train(no_docs, labels) is None and quality.train(docs, labels.limit(0)) is None
    assert {r.score for r in quality.score(docs.drop("score"), None).collect()} == {0.5}
    assert quality.score(no_docs.drop("score"), model).collect() == []


def test_the_sample_is_bounded(spark):
    rows = corpus(100)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    model = quality.train(docs, labels, sample_rows=10)
    assert len(model["labels"]) == 20
    assert model["weights"].sum() == pytest.approx(100)


def test_shapes_read_whole_words():
    assert quality._shape("a" * 64 + "123") != quality._shape("a" * 64 + "!!!ZZ")


def test_a_repeated_doc_id_is_one_sampled_text(spark):
    docs = [(1, f"copy number {i} of a long good text") for i in range(500)] + [(i, f"good words {i} here") for i in range(2, 40)] + [(i, f"$$$ BUY {i} NOW") for i in range(40, 80)]
    labels = [(i, int(i < 40)) for i in range(1, 80)]
    model = quality.train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"), sample_rows=30)
    assert len(model["labels"]) == 60 and sorted(set(model["labels"].tolist())) == [0, 1] and model["labels"].sum() == 30
