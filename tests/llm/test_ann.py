import numpy as np
import pytest

from ledgerline.llm import ann


def brute(vectors, every, k):
    usable = {i: np.array(v, float) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    width = max({len(v) for v in usable.values()}, key=lambda n: sum(len(v) == n for v in usable.values()), default=0)
    usable = {i: v for i, v in usable.items() if len(v) == width}
    out = {}
    for q, v in usable.items():
        if q % every == 0:
            scores = [(-float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))), i) for i, w in usable.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def rows(n=900, seed=1):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((6, 16))
    out = [(i, [float(np.float32(x)) for x in centres[i % 6] + 0.4 * r.standard_normal(16)]) for i in range(n)]
    for i in range(0, 120, 2):
        out[i] = (i, out[0][1])  # a group of copies, queries among them
    out = [(i, [float(np.float32(x)) for x in v]) for i, v in out]
    out += [(1000, None), (1001, [0.0] * 16), (1002, [1.0, None] + [0.0] * 14), (1050, [float("nan")] * 16), (1100, [float("inf")] + [1.0] * 15), (1150, [1.0, 2.0]), (None, [1.0] * 16), out[7], (1200, [2 * x for x in out[8][1]])]
    return out


SCHEMA = "vec_id long, embedding array<float>"


def test_recall_and_exact_scores(spark):
    data = rows()
    got = {}
    for r in ann.search(spark.createDataFrame(data, SCHEMA).repartition(3), every=10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(data, 10, 5)
    assert set(got) == set(want)
    vectors = {i: v for i, v in data if i is not None and v is not None}
    hits = total = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        for _, i, s in found:
            assert s == pytest.approx(exact_cosine(vectors[q], vectors[i]), abs=1e-12)
        hits += len({i for _, i, _ in found} & {i for i, _ in want[q]})
        total += 5
    assert hits / total >= 0.9


def exact_cosine(a, b):
    a, b = (np.array([float(np.float32(x)) for x in v]) for v in (a, b))
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def test_copies_go_by_id(spark):
    got = [tuple(r) for r in ann.search(spark.createDataFrame(rows(), SCHEMA), every=1000).collect()]
    assert [(r, i) for q, r, i, _ in sorted(got) if q == 0] == [(1, 2), (2, 4), (3, 6), (4, 8), (5, 10)]


def test_few_rows(spark):
    got = ann.search(spark.createDataFrame([(0, [1.0, 0.0]), (5, [1.0, 1.0]), (7, [0.0, 1.0])], SCHEMA), every=5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 5), (0, 2, 7), (5, 1, 0), (5, 2, 7)]
    assert ann.search(spark.createDataFrame([(0, [1.0])], SCHEMA)).collect() == []
    assert ann.search(spark.createDataFrame([], SCHEMA)).collect() == []
    assert ann.search(spark.createDataFrame([(0, None)], SCHEMA)).collect() == []


def test_every_leaf_is_visited_once():
    x = ann.unit(np.random.default_rng(2).standard_normal((700, 8)))
    tree = ann.Tree(x)
    assert sorted(tree.order(x[0])) == list(range(tree.leaves))
    assert next(tree.order(x[3])) == tree.place(x[3:4])[0]


def test_multiples_of_one_vector_go_by_id(spark):
    r = np.random.default_rng(3)
    noise = [(i, [float(np.float32(x)) for x in r.standard_normal(16)]) for i in range(700)]
    line = [(1000 + i * 5, [float(1 + (i * 7) % 40)] * 16) for i in range(40)]  # equal cosines, exact in doubles
    got = ann.search(spark.createDataFrame(noise + line, SCHEMA).repartition(4), every=100).collect()
    for query in (1000, 1100):
        found = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == query)
        assert [i for _, i, _ in found] == [i for i, _ in line if i != query][:5] and {s for _, _, s in found} == {1.0}


def test_the_cut_keeps_every_tie_before_it_chooses():
    vectors = np.vstack([np.ones((30, 4)) * np.arange(30, 0, -1)[:, None], np.eye(4)])
    q, rows, score = ann._best(np.array([7]), np.ones((1, 4)), np.arange(34), np.arange(100, 66, -1), vectors, 3)
    assert q.tolist() == [7, 7, 7] and rows.tolist() == [29, 28, 27] and score.tolist() == [1.0] * 3


def test_visited_runs_alone_are_searched():
    r = np.random.default_rng(4)
    vectors, queries = r.standard_normal((60, 8)), r.standard_normal((7, 8))
    runs = [(0, 20, np.array([0, 2, 3])), (20, 25, np.array([1, 3])), (25, 60, np.array([], int))]
    q, rows_, score = ann._best(np.arange(7), queries, np.arange(60), np.arange(60), vectors, 6, runs)
    for i, want in ((0, range(20)), (1, range(20, 25)), (2, range(20)), (3, range(25)), (4, [])):
        best = sorted(want, key=lambda n: -exact(queries[i], vectors[n]))[:6]
        assert rows_[q == i].tolist() == best and score[q == i].tolist() == pytest.approx([exact(queries[i], vectors[n]) for n in best])
    assert not len(ann._best(np.arange(7), queries, np.arange(60), np.arange(60), vectors, 6, [(0, 60, np.array([], int))])[0])


def exact(a, b):
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def test_cells_cut_rows_and_queries(spark, monkeypatch):
    """Shards of many parts, on both sides, find what whole shards find."""
    data = spark.createDataFrame(rows(), SCHEMA)
    whole = sorted(map(tuple, ann.search(data, every=10).collect()))
    monkeypatch.setattr(ann, "CELL_VALUES", 16 * 20)
    monkeypatch.setattr(ann, "CELL_QUERIES", 5)
    monkeypatch.setattr(ann, "WALK_QUERIES", 10)
    assert sorted(map(tuple, ann.search(data, every=10).collect())) == whole


def test_extra_columns_with_clashing_names(spark):
    from pyspark.sql import functions as F

    data = spark.createDataFrame(rows(300), SCHEMA)
    names = ["leaf", "shard", "ids", "n", "score", "query", "rank", "leaves"]
    more = data.select("*", *[F.lit("x").alias(c) for c in names])
    assert sorted(map(tuple, ann.search(more).collect())) == sorted(map(tuple, ann.search(data).collect()))
