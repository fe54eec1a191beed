"""Approximate nearest neighbours by cosine: a hierarchical k-means tree searched best bin first.

* The tree is fitted on a bounded sample of unit vectors; every row is then put in a leaf by descending to the nearest
  centroid.
* A query walks the tree through a priority queue of branches, nearest first, which orders the leaves.
* How many leaves to visit is calibrated: for a bounded set of calibration queries the exact neighbours are found by a
  scan of all rows, and visits widen until the target share of those neighbours lies in the visited leaves. A query
  goes on beyond that until its leaves hold enough rows.
* Neighbouring leaves form a shard. A query goes to a shard once, with the list of the leaves that it visits there, and
  one short list of its best rows comes back, however many leaves it visited. Queries and rows of a shard meet in cells
  (shard, part of its rows, part of its queries) of bounded size, so a crowded shard or leaf is many tasks. Equal
  vectors are one entry with their smallest ids, so copies neither crowd a leaf nor multiply comparisons.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.shared import staged

SAMPLE_ROWS = 32_768  # vectors that the tree is fitted on, at most
BRANCHES = 8
LEAF_ROWS = 48  # sample vectors in a leaf, about
CALIBRATION = 256  # calibration queries, at most
TARGET = 0.96  # share of their exact neighbours that the visited leaves must hold
SHARDS = 32  # groups of neighbouring leaves; a crowded one is cut into parts
CELL_VALUES, CELL_QUERIES = 1 << 22, 4096  # components of the rows of a cell, and its queries
BLOCK = 1 << 21  # products held at a time
WALK_QUERIES = 256  # queries that a task walks through the tree
MARGIN = 1e-12  # of a blocked product of unit vectors; its rounding error is far smaller
PAIRS = 1 << 16  # exact cosines computed at a time


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as a double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Tree:
    """Centroids of all nodes; node 0 is the root. ``children[i]`` is empty for a leaf, whose number is ``leaf[i]``."""

    def __init__(self, sample: np.ndarray) -> None:
        self.centroids, self.children, self.leaf, self.leaves = [sample.mean(axis=0)], [[]], [-1], 0
        random = np.random.default_rng(5)
        todo = [(0, np.arange(len(sample)))]
        while todo:
            node, rows = todo.pop()
            groups = self._split(sample[rows], random) if len(rows) > LEAF_ROWS else None
            if groups is None:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            for centre, members in groups:
                child = len(self.centroids)
                self.centroids.append(centre)
                self.children.append([])
                self.leaf.append(-1)
                self.children[node].append(child)
                todo.append((child, rows[members]))
        self.centroids = np.array(self.centroids)

    @staticmethod
    def _split(x: np.ndarray, random: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]] | None:
        k = min(BRANCHES, max(2, len(x) // LEAF_ROWS + 1))
        centres = x[random.choice(len(x), k, replace=False)]
        for _ in range(12):
            near = (x @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)
            centres = np.array([x[near == i].mean(axis=0) if (near == i).any() else centres[i] for i in range(k)])
        near = (x @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)
        groups = [(centres[i], np.flatnonzero(near == i)) for i in range(k) if (near == i).any()]
        return groups if len(groups) > 1 else None

    def place(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            children = self.children[node]
            if not children:
                out[rows] = self.leaf[node]
                continue
            centres = self.centroids[children]
            near = (x[rows] @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)
            todo += [(child, rows[near == i]) for i, child in enumerate(children) if (near == i).any()]
        return out

    def shard(self, leaf: int) -> int:
        """Leaves are numbered depth first, so a shard is a piece of the tree."""
        return leaf * SHARDS // self.leaves

    def order(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, nearest branch first."""
        away = ((self.centroids - query) ** 2).sum(axis=1)
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.children[node]:
                near = sorted(self.children[node], key=lambda c: away[c])
                for child in near[1:]:
                    heapq.heappush(queue, (away[child], child))
                node = near[0]
            yield self.leaf[node]


def _fit(table: pa.Table) -> pa.Table:
    table = table.sort_by("vec_id")
    return pa.table({"tree": pa.array([cloudpickle.dumps(Tree(unit(matrix(table.column("embedding")))))], pa.binary())})


def _products(queries: np.ndarray, vectors: np.ndarray, visits: list[tuple[int, int, np.ndarray]] | None) -> np.ndarray:
    """Products of all queries with all vectors, or with the runs of rows (from, to) that the numbered queries visit."""
    if visits is None:
        return queries @ vectors.T
    out = np.full((len(queries), len(vectors)), -np.inf)
    for start, stop, who in visits:
        out[who, start:stop] = queries[who] @ vectors[start:stop].T
    return out


def _best(query: np.ndarray, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, count: int, visits: list[tuple[int, int, np.ndarray]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the ``count`` rows of largest cosine, ties to smaller ``ids``: query numbers, row numbers, cosines.

    ``visits`` holds runs of rows (from, to) with the sorted places of the queries that look at them; without it every
    query looks at every row. A blocked product proposes every row within its rounding error of the ``count``-th best;
    the exact cosines of those decide, so rows of equal cosine (positive multiples of one vector) are never chosen by
    their place.
    """
    count = min(count, len(vectors))
    u = unit(vectors)
    found_q, found_r, found_s = [], [], []
    step = max(1, BLOCK // len(vectors))
    for first in range(0, len(queries), step):
        last = first + step
        inside = visits and [(a, b, who[np.searchsorted(who, first) : np.searchsorted(who, last)] - first) for a, b, who in visits]
        near = _products(unit(queries[first:last]), u, inside)
        least = np.partition(near, near.shape[1] - count, axis=1)[:, near.shape[1] - count]
        proposed_q, proposed_r = np.nonzero((near >= least[:, None] - MARGIN) & (near > -np.inf))
        if not len(proposed_q):
            continue
        score = np.concatenate([cosine(queries[first + proposed_q[i : i + PAIRS]], vectors[proposed_r[i : i + PAIRS]]) for i in range(0, len(proposed_q), PAIRS)])
        order = np.lexsort((ids[proposed_r], -score, proposed_q))
        q = proposed_q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = order[place < count]
        found_q.append(query[first + proposed_q[keep]])
        found_r.append(rows[proposed_r[keep]])
        found_s.append(score[keep])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_q]), np.concatenate([none, *found_r]), np.concatenate([np.zeros(0), *found_s])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows; the same pair gives the same bits wherever it is computed."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of the rows that take part: an id, all components finite, not all zero."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    return rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.expr("exists(embedding, x -> x <> 0)"))


def search(embeddings: DataFrame, every: int = 50, k: int = 5, target: float = TARGET) -> DataFrame:
    """Nearest rows (by cosine, in double precision) of every row whose vec_id is divisible by ``every``.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: ``k`` rows per query, or all other rows if there are
    fewer; ties go to the smaller vec_id. Vectors that are null, zero, or hold null or non-finite components take no
    part, nor do rows without an id and vectors of another length than most rows have (the shorter on a tie). Rows
    that repeat a vec_id with the same vector are one row.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    widths = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not widths:
        return empty
    rows = rows.filter(F.size("embedding") == widths[0]["width"]).distinct()
    # Equal vectors: one entry with its k + 1 smallest ids (a query may be one of them).
    order = Window.partitionBy("embedding").orderBy("vec_id")
    some = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    entries = staged(some.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.array_sort(F.collect_list("vec_id")).alias("ids")), "ann-entries")
    asking = staged(rows.filter(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id").join(entries.select("embedding", "vec_id"), "embedding"), "ann-queries")
    queries = asking.groupBy("vec_id").agg(F.first("embedding").alias("embedding"))

    total = entries.count()
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    few = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    tree: Tree = cloudpickle.loads(entries.filter(few).select("vec_id", "embedding").limit(2 * SAMPLE_ROWS).groupBy(F.lit("all").alias("sample")).applyInArrow(_fit, "tree binary").first().tree) if total > LEAF_ROWS else Tree(np.zeros((1, widths[0]["width"])))
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(tree))  # bounded by the sample

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(shared.value)
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("embedding"), b.column("ids"), pa.array(own.place(unit(matrix(b.column("embedding")))))], names=["vec_id", "embedding", "ids", "leaf"])

    placed = staged(entries.select("vec_id", "embedding", "ids").mapInArrow(put, "vec_id long, embedding array<double>, ids array<long>, leaf int"), "ann-leaves")
    held = {r.leaf: r["count"] for r in placed.groupBy("leaf").count().collect()}  # one row per leaf, bounded
    visits = _calibrate(placed, queries, tree, k, target)

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(shared.value)
        for b in batches:
            at, shards, leaves = [], [], []
            for i, q in enumerate(unit(matrix(b.column("embedding"))) if b.num_rows else []):
                have = seen = 0
                visited: dict[int, list[int]] = {}
                for leaf in own.order(q):
                    if leaf in held:
                        visited.setdefault(own.shard(leaf), []).append(leaf)
                        have += held[leaf]
                    seen += 1
                    if seen >= visits and have > k:
                        break
                at += [i] * len(visited)
                shards += visited.keys()
                leaves += visited.values()
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("vec_id").take(take), b.column("embedding").take(take), pa.array(shards, pa.int32()), pa.array(leaves, pa.list_(pa.int32()))], names=["vec_id", "embedding", "shard", "leaves"])

    tasks = max(1, math.ceil(queries.count() / WALK_QUERIES))
    asked = staged(queries.select("vec_id", "embedding").repartition(tasks, "vec_id").mapInArrow(walk, "vec_id long, embedding array<double>, shard int, leaves array<int>"), "ann-visits")
    sizes: dict[int, int] = {}
    for leaf, count in held.items():
        sizes[tree.shard(leaf)] = sizes.get(tree.shard(leaf), 0) + count
    askers = {r.shard: r["count"] for r in asked.groupBy("shard").count().collect()}  # one row per shard
    cell_rows = max(1, CELL_VALUES // widths[0]["width"])
    parts = F.broadcast(spark.createDataFrame([(i, math.ceil(n / cell_rows), math.ceil(askers[i] / CELL_QUERIES)) for i, n in sizes.items() if i in askers], "shard int, row_parts int, query_parts int"))  # at most SHARDS rows
    r = placed.withColumn("shard", F.expr(f"cast(leaf * {SHARDS}L div {tree.leaves} as int)")).join(parts, "shard").withColumn("row_part", F.expr("cast(pmod(xxhash64(vec_id), row_parts) as int)")).withColumn("query_part", F.explode(F.expr("sequence(0, query_parts - 1)")))
    q = asked.join(parts, "shard").withColumn("query_part", F.expr("cast(pmod(xxhash64(vec_id), query_parts) as int)")).withColumn("row_part", F.explode(F.expr("sequence(0, row_parts - 1)")))
    cell = ["shard", "row_part", "query_part"]

    def meet(asks: pa.Table, there: pa.Table) -> pa.Table:
        if not asks.num_rows or not there.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "ids": pa.array([], pa.list_(pa.int64()))})
        there = there.sort_by("leaf")
        leaf = there.column("leaf").to_numpy()
        lists = asks.column("leaves").combine_chunks()
        wanted, who = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        order = np.lexsort((who, wanted))
        wanted, who = wanted[order], who[order]
        runs = [(*np.searchsorted(leaf, [n, n + 1]).tolist(), who[slice(*np.searchsorted(wanted, [n, n + 1]))]) for n in np.unique(leaf)]
        a, b, s = _best(asks.column("vec_id").to_numpy(), matrix(asks.column("embedding")), np.arange(there.num_rows), there.column("vec_id").to_numpy(), matrix(there.column("embedding")), k + 1, runs)
        at = pa.array(b)
        return pa.table({"query": pa.array(a), "vec_id": there.column("vec_id").take(at), "score": pa.array(s), "ids": there.column("ids").take(at)})

    met = q.select(*cell, "vec_id", "embedding", "leaves").groupBy(*cell).cogroup(r.select(*cell, "vec_id", "embedding", "ids", "leaf").groupBy(*cell)).applyInArrow(meet, "query long, vec_id long, score double, ids array<long>")
    near = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = staged(met.withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1).select("query", "score", "ids"), "ann-best")
    each = asking.select("query_id", F.col("vec_id").alias("query")).join(best, "query").select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _calibrate(placed: DataFrame, queries: DataFrame, tree: Tree, k: int, target: float) -> int:
    """Leaves to visit so that ``target`` of the exact neighbours of the calibration queries are found."""
    chosen = queries.orderBy(F.xxhash64("vec_id")).limit(CALIBRATION).collect()
    if not chosen:
        return 1
    ids, vectors = np.array([r.vec_id for r in chosen]), np.array([r.embedding for r in chosen])
    shared = placed.sparkSession.sparkContext.broadcast((ids, vectors))  # at most CALIBRATION vectors

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                a, r, s = _best(*shared.value, np.arange(b.num_rows), b.column("vec_id").to_numpy(), matrix(b.column("embedding")), k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(a), b.column("vec_id").take(pa.array(r)), b.column("leaf").take(pa.array(r)), pa.array(s)], names=["query", "vec_id", "leaf", "score"])

    near = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    exact = placed.select("vec_id", "embedding", "leaf").mapInArrow(scan, "query long, vec_id long, leaf int, score double").filter("vec_id <> query")
    found = exact.withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k).select("query", "leaf").collect()
    wanted: dict[int, list[int]] = {}
    for r in found:
        wanted.setdefault(r.query, []).append(r.leaf)
    depth = []
    for query, vector in zip(ids.tolist(), unit(vectors), strict=True):
        place = {leaf: n for n, leaf in enumerate(tree.order(vector), 1)}
        depth += [place[leaf] for leaf in wanted.get(query, [])]
    depth.sort()
    return depth[max(0, math.ceil(target * len(depth)) - 1)] if depth else 1
