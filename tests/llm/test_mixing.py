import math
import re

import pytest

from ledgerline.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens_by_source(rows):
    out = {}
    for r in rows:
        if n := len(WORD.findall(r[1] or "")):
            out[r[3]] = out.get(r[3], 0) + n
    return out


def check_draw(drawn, rows, budget, exponent):
    """Quotas, whole epochs and a fitting beginning of the last, in permutation order."""
    n = tokens_by_source(rows)
    total = sum(n.values())
    z = sum((x / total) ** exponent for x in n.values())
    for source, own in n.items():
        weight = (own / total) ** exponent / z
        quota = math.floor(weight * budget + 1e-6)
        mine = [r for r in drawn if r.row.source == source]
        assert all(r.weight == pytest.approx(weight) for r in mine)
        texts = sorted((r[0] is None, r[0] or 0, r[1]) for r in rows if r[3] == source and WORD.findall(r[1] or ""))
        for epoch in range(1, quota // own + 1):
            assert sorted((r.row.doc_id is None, r.row.doc_id or 0, r.row.text) for r in mine if r.epoch == epoch) == texts
        last = [r for r in mine if r.epoch == quota // own + 1]
        assert max((r.epoch for r in mine), default=0) <= quota // own + 1
        used = sum(r.n_tokens for r in last)
        assert used <= quota % own
        # what was left out of the block where the quota ends does not fit before its first missing document
        if last:
            assert len({r.block for r in last}) >= 1
        longest = max((len(WORD.findall(r[1] or "")) for r in rows if r[3] == source), default=0)
        assert quota % own - used < max(longest, 1)


def test_draws_match_quotas(docs, rows):
    n = tokens_by_source(rows)
    for budget, repetitions in ((sum(n.values()), 2.0), (3 * sum(n.values()), 4.0), (50, 1.5)):
        t = mixing.temperature(mixing.source_tokens(docs), budget, repetitions=repetitions)
        check_draw(mixing.mix(docs, budget=budget, repetitions=repetitions).collect(), rows, budget, t)


def test_temperature_meets_its_target(spark):
    n = {"a": 100_000, "b": 10_000, "c": 100}
    sources = spark.createDataFrame(list(n.items()), "source string, tokens long")
    total = sum(n.values())

    def weights(t):
        z = sum((x / total) ** t for x in n.values())
        return {s: (x / total) ** t / z for s, x in n.items()}

    t = mixing.temperature(sources, total, repetitions=5.0)
    assert max(w * total / n[s] for s, w in weights(t).items()) == pytest.approx(5.0, rel=1e-6)
    t = mixing.temperature(sources, total, entropy=0.8)
    assert -sum(w * math.log(w) for w in weights(t).values()) == pytest.approx(0.8, rel=1e-6)
    assert mixing.temperature(sources, total, entropy=2.0) == 0.0
    assert mixing.temperature(sources, 10 * total, repetitions=2.0) == 1.0
    with pytest.raises(ValueError):
        mixing.temperature(sources, total)


def test_many_small_documents(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'a b c' as text", "if(id % 10 = 0, 'small', 'hot') as source")
    drawn = mixing.mix(docs, repetitions=3.0).collect()
    small = [r for r in drawn if r.row.source == "small"]
    assert 1190 <= len(small) <= 1200 and {r.epoch for r in small} <= {1, 2, 3}
    hot = {r.row.doc_id for r in drawn if r.row.source == "hot"}
    assert abs(3 * (len(hot) + len(small)) - 12_000) <= 6


def test_sources_without_a_quota_are_not_drawn(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "'a b c' as text", "if(id % 100 = 0, 'small', 'hot') as source")
    for budget, target in ((10, {"repetitions": None, "entropy": 0.0}), (1, {"repetitions": 2.0}), (0, {"repetitions": 2.0})):
        quota = {r.source: r.quota for r in mixing.quotas(mixing.source_tokens(docs), mixing.temperature(mixing.source_tokens(docs), budget, **target), budget).collect()}
        drawn = mixing.mix(docs, budget=budget, **target).collect()
        assert 0 in quota.values() and all(r.epoch >= 1 for r in drawn)
        for source, most in quota.items():
            assert sum(r.n_tokens for r in drawn if r.row.source == source) <= most
        assert len(drawn) == (3 if budget == 10 else 0)


def test_empty_table(no_docs):
    assert mixing.mix(no_docs).collect() == []


def test_texts_are_split_once_a_pass(docs, monkeypatch):
    plans = []
    write = mixing.staged
    monkeypatch.setattr(mixing, "staged", lambda df, label: plans.append(df) or write(df, label))
    plans.append(mixing.mix(docs))
    for df in plans:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_extract_all" in line]
