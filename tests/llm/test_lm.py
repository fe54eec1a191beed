import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HELD = "crc32(cast(doc_id as string)) % 7 = 2"


def brute(rows):
    """Katz bigram by dictionaries."""
    texts = [(r[0], None if r[0] is None else zlib.crc32(str(r[0]).encode()) % 7 == 2, ["<s>", *WORD.findall((r[1] or "").translate(LOWER)), "</s>"]) for r in rows]
    one, two = {}, {}
    for _, held, t in texts:
        if held is False:
            for a, b in zip(t, t[1:]):
                one[b] = one.get(b, 0) + 1
                two[a, b] = two.get((a, b), 0) + 1
    history = {}
    for (a, _), c in two.items():
        history[a] = history.get(a, 0) + c
    often = lambda counts: [sum(c == r for c in counts.values()) for r in range(1, lm.K + 2)]
    d1, d2 = lm.discounts(often(one)), lm.discounts(often(two))
    n = sum(one.values())
    cut = lambda d, c: d[min(c, lm.K + 1)] * c
    lost = sum(c - cut(d1, c) for c in one.values())
    n1 = n if lost > 0 else n + 1
    p1 = {w: cut(d1, c) / n1 for w, c in one.items()}
    unknown = 1 - sum(p1.values())
    followers = {}
    for (a, b), c in two.items():
        followers.setdefault(a, []).append((b, c))
    weight, size = {}, {}
    for a, own in followers.items():
        loss = sum(c - cut(d2, c) for _, c in own)
        size[a] = history[a] + (0 if loss > 0 else 1)
        weight[a] = (1 - sum(cut(d2, c) for _, c in own) / size[a]) / (1 - sum(p1[b] for b, _ in own))

    def p(a, b):
        if (a, b) in two:
            return cut(d2, two[a, b]) / size[a]
        return weight.get(a, 1.0) * p1.get(b, unknown)

    out = []
    for doc, held, t in texts:
        base = sum(math.log10((one.get(b, 0) + 1) / (n + len(one) + 1)) for b in t[1:])
        out.append((doc, held, len(t) - 1, sum(b in one for b in t[1:]), n, base, sum(math.log10(p(a, b)) for a, b in zip(t, t[1:]))))
    vocabulary = [*one, None]
    return out, {a: sum(p(a, b) for b in vocabulary) for a in [*followers, "never seen"]}


def test_matches_brute_force(docs, rows):
    want, masses = brute(rows)
    got = [tuple(r) for r in lm.score(docs, HELD).collect()]
    key = lambda r: (str(r[0]), r[2], r[5])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)
    for mass in masses.values():
        assert mass == pytest.approx(1, abs=1e-9)


def test_small_blocks_give_the_same(docs, monkeypatch):
    key = lambda r: (str(r.doc_id), r.n_tokens, r.base_score)
    one = sorted(lm.score(docs, HELD).collect(), key=key)
    two = sorted(lm.score(docs.repartition(17), HELD).collect(), key=key)
    for a, b in zip(one, two, strict=True):
        assert a[:5] == b[:5] and a.score == pytest.approx(b.score, rel=1e-9)


def test_stored_model_scores_the_same_and_another_corpus(spark, docs, rows, no_docs, tmp_path):
    want, _ = brute(rows)
    key = lambda r: (str(r[0]), r[1], r[3])
    stored = lm.fit(docs, HELD)
    stored.save(f"file:{tmp_path}/model")
    read = lm.Stored.load(spark, f"file:{tmp_path}/model")
    for model in (stored, read):
        got = sorted((tuple(r) for r in model.score(docs.withColumn("score", F.lit("x")).repartition(3)).collect()), key=key)
        assert len(got) == len(want)
        for a, b in zip(got, sorted(((d, t, k, base, s) for d, _, t, k, _, base, s in want), key=key), strict=True):
            assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9, abs=1e-9)
    # texts that training never saw, scored with the rows that taught: crc32 of these ids leaves no remainder of 2
    others = [i for i in range(10_000, 10_100) if zlib.crc32(str(i).encode()) % 7 == 2]
    texts = ["", "never SEEN words", (rows[0][1] or "a") + " unknown", " ".join((r[1] or "")[:40] for r in rows[:9]), "x " * 3000, None]
    new = list(zip(others, texts, strict=False))
    want = {r[0]: r for r in brute([(r[0], r[1]) for r in rows] + new)[0]}
    for r in read.score(spark.createDataFrame(new, "doc_id long, text string")).collect():
        b = want[r.doc_id]
        assert (r.n_tokens, r.n_known) == (b[2], b[3]) and (r.base_score, r.score) == pytest.approx(b[5:], rel=1e-9)
    assert read.score(no_docs).collect() == []


def test_weights_are_stored_once_a_history_and_dealt_requests_change_nothing(docs, rows, monkeypatch):
    stored = lm.fit(docs, HELD)
    _, masses = brute(rows)
    sizes = [len(np.frombuffer(r.weights)) for r in stored.weights.collect()]
    assert sum(sizes) == len(masses) - 1
    one = sorted(map(tuple, stored.score(docs).collect()), key=str)
    monkeypatch.setattr(lm, "plan_bytes", lambda _: 5 * stored.buckets * lm.BUCKET_BYTES)
    two = sorted(map(tuple, stored.score(docs).collect()), key=str)
    for a, b in zip(one, two, strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9)


def test_a_stored_model_of_nothing(docs):
    got = lm.fit(docs, "true").score(docs).collect()
    assert {r.score for r in got} == {0.0} and {r.n_known for r in got} == {0}


def test_nothing_to_learn_from_and_empty_table(docs, no_docs):
    got = lm.score(docs, "true").collect()
    assert {r.train_tokens for r in got} == {0} and {r.n_known for r in got} == {0} and {r.score for r in got} == {0.0}
    assert lm.score(no_docs, HELD).collect() == []


def test_discounts_lie_between_zero_and_one():
    for often in ([0] * 6, [10, 5, 3, 2, 1, 1], [5, 0, 0, 0, 0, 0], [1000, 200, 80, 40, 25, 18], [0, 3, 0, 0, 0, 9]):
        d = lm.discounts(often)
        assert (d[1 : lm.K + 1] > 0).all() and (d[1 : lm.K + 1] <= 1).all() and d[lm.K + 1] == 1
    turing = lm.discounts([1000, 200, 80, 40, 25, 18])
    mass = sum((1 - turing[r]) * r * n for r, n in enumerate([1000, 200, 80, 40, 25], 1))
    assert mass == pytest.approx(1000)  # Katz: the discounted mass is that of the n-grams seen once
    assert not np.isnan(turing).any()


def test_base_score_of_a_given_table_counted_plainly(spark):
    from ledgerline.llm.queries import op1_katz_backoff
    from tests.conftest import SF_SMALL

    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    tokens = {r.doc_id: [t for t in re.split(r"[ \t-\r]+", (r.text or "").translate(LOWER)) if t] + [None] for r in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count: dict = {}
    for i, own in tokens.items():
        for t in [] if held[i] else own:
            count[t] = count.get(t, 0) + 1
    total, size = sum(count.values()), len(count)
    assert any(re.search("[A-Z]", r.text or "") for r in rows)
    for r in op1_katz_backoff(spark, SF_SMALL).collect():
        own = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(t in count for t in own), total)
        assert r.base_score == pytest.approx(sum(math.log10((count.get(t, 0) + 1) / (total + size + 1)) for t in own), rel=1e-12)
