"""Centroid clustering by Lloyd's rounds over column blocks, in whole numbers.

Vectors are cut into tiles of rows, and a tile into blocks of ``width`` columns (``shard``); a block is one packed row of a
table partitioned by shard. In every round

1. the tasks of a shard read its blocks and its slice of the centroids, and compute exact partial squared distances;
2. the partial distances of a tile are added up over the shards, and the smallest sum gives the cluster of each vector;
3. the tasks of a shard meet the clusters of their tiles and add up their own columns per cluster; the floor of sum over
   count is the shard's new slice.

All arithmetic is on integers, so no result depends on the partitioning. What the driver holds is the centroids: ``k``
times the number of columns, parameters both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import staged

MOST = 1 << 26  # largest component: squares of differences over 512 columns still fit 64 bits
GROUP_BYTES = 16 << 20  # partial distances of one tile over all shards
IDS = -1  # the shard that holds the ids of a tile


@dataclass
class Clusters:
    assigned: DataFrame  # id column, cluster int, distance long; one row per vector that was kept
    centroids: list[list[int]]


def whole_vectors(df: DataFrame, id_column: str, column: str, dims: int, scale: int) -> DataFrame:
    """``id`` and ``v`` (floor of scale times each component) of the vectors of ``dims`` finite components."""
    vector = F.col(column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))  # NaN is above infinity
    kept = df.filter((F.size(vector) == dims) & finite)
    return kept.select(F.col(id_column).cast("long").alias("id"), F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))).cast("int")).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``<seed>:<id>``, in that order; equal ids in order of components."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return [list(r.v) for r in vectors.filter("id is not null").orderBy(order, "v").limit(k).collect()]


def _tiles(rows: int, dims: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = TaskContext.get().partitionId() << 32
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(-1, dims)
            if len(flat) and np.abs(flat.astype(np.int64)).max() > MOST:
                raise ValueError(f"a scaled component is beyond {MOST}")
            for at in range(0, len(flat), rows):
                part, ids = flat[at : at + rows], batch.column("id")[at : at + rows].to_pylist()
                blocks = [np.ascontiguousarray(part[:, c : c + width]).tobytes() for c in range(0, dims, width)]
                n = len(blocks) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tile] * n, pa.int64()), pa.array(range(IDS, n - 1), pa.int32()), pa.array([len(part)] * n, pa.int32()), pa.array([ids, *[None] * (n - 1)], pa.list_(pa.int64())), pa.array([None, *blocks], pa.binary())],
                    ["tile", "shard", "n", "ids", "block"],
                )
                tile += 1

    return cut


def _slices(centroids: list[list[int]], width: int) -> list[np.ndarray]:
    whole = np.array(centroids, np.int64)
    return [whole[:, c : c + width] for c in range(0, whole.shape[1], width)]


def _partial(slices: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                centres = slices[row["shard"]]
                block = np.frombuffer(row["block"], np.int32).reshape(row["n"], -1).astype(np.int64)
                square = np.empty((len(centres), len(block)), np.int64)
                for j, centre in enumerate(centres):
                    gap = block - centre
                    square[j] = np.einsum("ij,ij->i", gap, gap)
                packed = square.astype(np.uint32) if square.max(initial=0) < 1 << 32 else square
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tile"]], pa.int64()), pa.array([row["n"]], pa.int32()), pa.array([packed.itemsize], pa.int32()), pa.array([packed.tobytes()], pa.binary())],
                    ["tile", "n", "item", "square"],
                )

    return measure


def _nearest(table: pa.Table) -> pa.Table:
    """Adds the partial distances of one tile and takes the nearest centroid (``argmin``: the smaller number of equals)."""
    total = None
    for row in table.to_pylist():
        part = np.frombuffer(row["square"], np.uint32 if row["item"] == 4 else np.int64).reshape(-1, row["n"]).astype(np.int64)
        total = part if total is None else total + part
    cluster = total.argmin(axis=0).astype(np.int32)
    distance = total[cluster, np.arange(total.shape[1])]
    return pa.table({"tile": table.column("tile")[:1], "cluster": pa.array([cluster.tobytes()], pa.binary()), "distance": pa.array([distance.tobytes()], pa.binary())})


def assign(blocks: DataFrame, centroids: list[list[int]], width: int) -> DataFrame:
    """``tile`` with the packed clusters and squared distances of its vectors."""
    measured = blocks.filter(f"shard <> {IDS}").select("tile", "shard", "n", "block")
    partial = measured.mapInArrow(_partial(_slices(centroids, width)), "tile long, n int, item int, square binary")
    return partial.groupBy("tile").applyInArrow(_nearest, "tile long, cluster binary, distance binary")


def _own_sums(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                block = np.frombuffer(row["block"], np.int32).reshape(row["n"], -1).astype(np.int64)
                cluster, shard = np.frombuffer(row["cluster"], np.int32), row["shard"]
                own = sums.setdefault(shard, np.zeros((k, block.shape[1]), np.int64))
                np.add.at(own, cluster, block)
                counts[shard] = counts.get(shard, 0) + np.bincount(cluster, minlength=k)
        for shard, own in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * k, pa.int32()), pa.array(range(k), pa.int32()), pa.array(counts[shard].tolist(), pa.int64()), pa.array(own.tolist(), pa.list_(pa.int64()))],
                ["shard", "cluster", "n", "sums"],
            )

    return add


def update(blocks: DataFrame, assigned: DataFrame, centroids: list[list[int]], width: int) -> list[list[int]]:
    """New centroids: per shard and cluster the floor of the componentwise mean; an empty cluster keeps its centroid."""
    own = blocks.filter(f"shard <> {IDS}").select("tile", "shard", "n", "block")
    met = own.join(assigned.select("tile", "cluster").hint("merge"), "tile").select("shard", "n", "block", "cluster")
    sums = met.mapInArrow(_own_sums(len(centroids)), "shard int, cluster int, n long, sums array<long>")
    columns = sums.select("shard", "cluster", "n", F.posexplode("sums").alias("column", "value"))
    total = columns.groupBy("shard", "cluster", "column").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).filter("n > 0")
    found = total.select("shard", "cluster", "column", F.expr("(value - pmod(value, n)) div n").alias("mean"))
    new = [list(c) for c in centroids]
    for r in found.collect():  # at most k times the number of columns
        new[r.cluster][r.shard * width + r.column] = r.mean
    return new


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(np.frombuffer(row["cluster"], np.int32)), pa.array(np.frombuffer(row["distance"], np.int64))],
                ["id", "cluster", "distance"],
            )


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1", width: int = 16, id_column: str = "vec_id", vector_column: str = "embedding") -> Clusters:
    """Clusters of the vectors of ``df`` after ``rounds`` rounds from hashed starting vectors, and one last assignment.

    Only vectors with exactly ``dims`` components, all finite, take part (a null vector, or one that holds a null, doesn't);
    a component becomes floor(scale * x), and beyond ``MOST`` the run stops with an error. Ties go to the smaller
    centroid number. Fewer than ``k`` vectors give fewer centroids. A vector with a null id is clustered but never a
    starting vector; rows that repeat an id are each a vector, equal ones included. An empty table gives no rows. Other
    columns are ignored.
    """
    vectors = whole_vectors(df, id_column, vector_column, dims, scale)
    shards = -(-dims // width)
    rows = max(1, min(4096, GROUP_BYTES // (8 * k * shards)))
    blocks = staged(vectors.mapInArrow(_tiles(rows, dims, width), "tile long, shard int, n int, ids array<long>, block binary"), "lloyd-blocks", ["shard"])
    centroids = first_centroids(vectors, k, seed)
    if not centroids:
        ids_only = blocks.filter("false").select(F.lit(None).cast("long").alias(id_column), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clusters(ids_only, [])
    for _ in range(rounds):
        centroids = update(blocks, assign(blocks, centroids, width), centroids, width)
    ids = blocks.filter(f"shard = {IDS}").select("tile", "ids")
    packed = ids.join(assign(blocks, centroids, width).hint("merge"), "tile").select("ids", "cluster", "distance")
    assigned = staged(packed.mapInArrow(_unpack, "id long, cluster int, distance long"), "lloyd-assigned")
    return Clusters(assigned.withColumnRenamed("id", id_column), centroids)


def digest(found: Clusters) -> DataFrame:
    """Every vector with its cluster, the inertia of its cluster and of all, and the hash of its centroid."""
    spark = found.assigned.sparkSession
    hashes = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(found.centroids)]
    named = spark.createDataFrame(hashes, "cluster int, centroid_sha256 string")
    each = found.assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = found.assigned.agg(F.sum("distance").alias("inertia"))
    totals = each.join(named, "cluster").crossJoin(whole)  # a row per centroid
    return found.assigned.join(F.broadcast(totals), "cluster").select(found.assigned.columns[0], "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
