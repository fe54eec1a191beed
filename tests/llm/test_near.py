import re

import numpy as np

from ledgerline.llm import near
from ledgerline.llm.shared import connected_components
from ledgerline.llm.text import word_block

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def brute(rows, n, percent):
    """Component of each row's doc_id by comparing all pairs."""
    sets = [(r[0], shingles(r[1], n)) for r in rows]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = sorted((find(a), find(b)))
                parent[v] = u
    return sorted(((a, len(x), None if a is None else find(a), a is None or find(a) == a) for a, x in sets), key=str)


def test_components_match_brute_force(docs, rows):
    for n, percent in ((3, 85), (5, 80)):
        got = sorted((tuple(r) for r in near.near_duplicates(docs, n, percent).collect()), key=str)
        assert got == brute(rows, n, percent)


def test_small_tiles_find_the_same_links(docs, rows):
    got = sorted((tuple(r) for r in near.near_duplicates(docs, 3, 85, tile=2).collect()), key=str)
    assert got == brute(rows, 3, 85)


def test_bands_keep_the_miss_bound():
    assert near.banding(85) == (16, 4) and near.banding(80) == (22, 4)
    for percent in range(1, 101):
        bands, rows = near.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= near.MISS


def test_pairs_at_a_low_threshold_are_found(spark):
    rows = []
    for i in range(200):  # pairs with 20 of 40 words in common
        words = [f"p{i}w{j}" for j in range(40)]
        rows += [(2 * i, " ".join(words[:30])), (2 * i + 1, " ".join(words[:20] + words[30:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs, 1, 50).collect()}
    assert got == {i: i // 2 * 2 for i in range(400)}


def test_empty_table(no_docs):
    assert near.near_duplicates(no_docs).collect() == []


def test_signature_estimates_similarity():
    import pyarrow as pa

    a = [f"w{i}" for i in range(400)]
    b = a[:300] + [f"x{i}" for i in range(100)]
    grams, starts = near.shingle_sets(word_block(pa.array([" ".join(a), " ".join(b)])), 1)
    s = near.circulant_signatures(grams, starts, 512)
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.08
    assert len(np.unique(s[0])) > 200


def test_connected_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 99), (100, 98), (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    want = {i: 0 for i in range(41)} | {98: 98, 99: 98, 100: 98, 200: 200, 201: 200}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
