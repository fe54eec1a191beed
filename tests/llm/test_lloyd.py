import hashlib
import math
import random

import pytest

from ledgerline.llm import lloyd

SCHEMA = "vec_id long, embedding array<float>, cluster int, distance long, id long, tile long"


def table(n: int, dims: int) -> list[tuple]:
    r = random.Random(11)
    centres = [[r.uniform(-2, 2) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [round((c + r.gauss(0, 0.4)) * 64) / 64 + r.choice([0, 0.004]) for c in r.choice(centres)]) for i in range(n)]
    same = rows[3][1]
    rows += [(n + i, same) for i in range(40)]  # a large group of equal vectors
    rows += [rows[7], rows[7], (rows[8][0], rows[9][1]), (None, rows[10][1])]  # repeated rows and ids, a null id
    bad = [None, [], same[:-1], [*same, 0.0], [None, *same[1:]], [math.nan, *same[1:]], [math.inf, *same[1:]], [-math.inf, *same[1:]]]
    rows += [(10_000 + i, v) for i, v in enumerate(bad)]
    return [(*row, 1, 1, 1, 1) for row in rows]


def brute(rows: list[tuple], k: int, rounds: int, dims: int, scale: int) -> tuple[list, list]:
    """Plain loops over whole vectors."""
    import numpy as np

    kept = [(r[0], [math.floor(scale * float(np.float32(x))) for x in r[1]]) for r in rows if r[1] is not None and len(r[1]) == dims and all(x is not None and math.isfinite(x) for x in r[1])]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in start[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, members in groups.items():
            centres[j] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centres


def key(row: tuple) -> tuple:
    return (row[0] is None, row)


def check(spark, rows, **settings):
    settings = {"k": 16, "rounds": 3, "dims": 64, "scale": 64, **settings}
    width = settings.pop("width", 16)
    found = lloyd.cluster(spark.createDataFrame(rows, SCHEMA).repartition(5), width=width, **settings)
    expected, centres = brute(rows, **settings)
    assert found.centroids == centres
    assert sorted((tuple(r) for r in found.assigned.collect()), key=key) == sorted(expected, key=key)
    return found, expected, centres


def test_equals_plain_lloyd(spark):
    rows = table(400, 64)
    found, expected, centres = check(spark, rows)
    total = sum(r[2] for r in expected)
    digest = lloyd.digest(found)
    assert digest.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    got = digest.collect()
    assert len(got) == len(expected) and {r.inertia for r in got} == {total}
    for j, centre in enumerate(centres):
        mine = [r for r in got if r.cluster == j]
        assert all(r.cluster_inertia == sum(x.distance for x in mine) for r in mine)
        assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest() for r in mine)


def test_ragged_shards_and_other_parameters(spark):
    check(spark, table(60, 10), k=4, rounds=2, dims=10, scale=10, width=4)


def test_fewer_vectors_than_centroids_and_empty_clusters(spark):
    rows = [(i, [float(i % 2)] * 64, 1, 1, 1, 1) for i in range(9)]
    found, expected, _ = check(spark, rows)
    assert len(found.centroids) == 9 and len({r[1] for r in expected}) == 2


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1, 1, 1, 1), (2, [1.0], 1, 1, 1, 1)]):
        found = lloyd.cluster(spark.createDataFrame(rows, SCHEMA))
        assert lloyd.digest(found).count() == 0


def test_large_components_stay_exact(spark):
    big = float(1 << 19)
    rows = [(i, [big * (-1) ** i + i] * 64, 1, 1, 1, 1) for i in range(30)]
    check(spark, rows, k=3)


def test_components_beyond_the_exact_range_stop_the_run(spark):
    rows = [(i, [float(1 << 21)] * 64, 1, 1, 1, 1) for i in range(3)]
    with pytest.raises(Exception, match="is beyond"):
        lloyd.cluster(spark.createDataFrame(rows, SCHEMA))
