"""MinHash near-dedup with circulant signatures.

Two permutations make every signature coordinate: an initial one scatters the shingles over the ring of 2^32 places,
and one further permutation, circularly shifted by k, gives coordinate k (Li and Li, "C-MinHash"). Bands of the
signature propose candidates; links are confirmed by the exact Jaccard similarity of the full shingle sets.

Work per step, none of it quadratic in a group of copies:

1. One map over whole texts gives each row its set size, a 128-bit fingerprint of its shingle set, and the band hashes.
2. Rows with equal fingerprints form a class, found by a partial aggregate; only one row of a class goes on, so copies
   are never expanded.
3. Classes that share a band are linked to the smallest of the band's bucket (again an aggregate and a join), and the
   connected components of those unconfirmed links are the clusters: every banded pair lies inside one cluster.
4. The texts of the cluster members are compared exactly. A cluster is cut into tiles of ``TILE`` members, and a task
   takes two tiles; it compares all their members through one table of shingle numbers and returns a spanning forest
   of the confirmed links, never the pairs.
5. Components of the confirmed links, joined back to the rows by fingerprint.

Bands follow from the threshold: a pair at it is missed by all bands with probability ``MISS`` at most, and clusters join
most of those again. At 0.85 these are 16 bands of 4 coordinates (7e-6), at 0.8, as in the pipeline, 22 (9.3e-6).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import connected_components, staged
from ledgerline.llm.text import WordBlock, bounded, gram_hashes, inside, mix64, word_block

MISS = 1e-5  # chance at most that a pair at the threshold shares no band
ROWS = 4  # coordinates of a band at most
COORDINATES = 300  # of a signature; bands of fewer coordinates, if it takes more
TILE = 384
SIGMA = np.uint64(0x5851F42D4C957F2D)


def banding(percent: float) -> tuple[int, int]:
    """Bands and coordinates of each, so that a pair of similarity ``percent`` / 100 is missed with probability ``MISS`` at most."""
    if percent <= 0:
        raise ValueError("percent must be above 0: texts without a common shingle share no band")
    share = min(percent / 100, 1.0)
    for rows in range(ROWS, 0, -1):
        one = share**rows  # chance that a band agrees
        bands = 1 if one == 1 else math.ceil(math.log(MISS) / math.log1p(-one))
        if rows == 1 or bands * rows <= COORDINATES:
            return bands, rows


def shingle_sets(block: WordBlock, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each text's set begins.

    A text of fewer words than ``n`` has its whole word sequence as the one shingle; without words its set is empty.
    """
    texts = len(block.starts) - 1
    lengths = np.diff(block.starts)
    grams = gram_hashes(block.hashes[block.codes], n)
    ok = inside(block.starts, n)
    rows, grams = block.rows[: len(grams)][ok], grams[ok]
    short = np.flatnonzero((lengths > 0) & (lengths < n))
    if len(short):
        whole = [gram_hashes(block.hashes[block.codes[block.starts[i] : block.starts[i + 1]]], int(lengths[i]))[0] for i in short]
        rows, grams = np.concatenate([rows, short]), np.concatenate([grams, np.array(whole, np.uint64)])
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    first = np.ones(len(grams), bool)
    first[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
    rows, grams = rows[first], grams[first]
    return grams, np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=texts))]).astype(np.int64)


def _pi(x: np.ndarray) -> np.ndarray:
    """The permutation of the ring that is shifted (a bijective 32-bit finaliser)."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def circulant_signatures(grams: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """Signatures (one row per non-empty set): coordinate k is the minimum of pi(sigma(x) - k) over the set."""
    begins = starts[:-1][np.diff(starts) > 0]
    out = np.empty((len(begins), coordinates), np.uint32)
    if not len(begins):
        return out
    placed = (mix64(grams ^ SIGMA) >> np.uint64(32)).astype(np.uint32)
    for k in range(coordinates):
        out[:, k] = np.minimum.reduceat(_pi(placed - np.uint32(k)), begins)
    return out


def _describe(n: int, count: int, width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            grams, starts = shingle_sets(word_block(batch.column("text"), lower=True), n)
            sizes = np.diff(starts)
            full = np.flatnonzero(sizes)
            fps = np.zeros((len(sizes), 2), np.uint64)
            bands = np.zeros((len(full), count), np.uint64)
            if len(full):
                signatures = circulant_signatures(grams, starts, count * width).astype(np.uint64)
                for lane, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
                    fps[full, lane] = np.add.reduceat(mix64(grams + np.uint64(salt)), starts[:-1][full])
                for b in range(count):
                    h = np.full(len(full), b + 1, np.uint64)
                    for k in range(b * width, (b + 1) * width):
                        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + signatures[:, k])
                    bands[:, b] = h
            ends = np.zeros(len(sizes) + 1, np.int32)
            ends[1:] = np.cumsum(np.where(sizes > 0, count, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array([x.tobytes() for x in fps], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.reshape(-1).view(np.int64)))],
                schema=schema,
            )

    return run


def _links(n: int, percent: int):
    """Confirmed links among the members of two tiles of a cluster, as a spanning forest."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        tiles = table.column("tile").to_numpy()
        grams, starts = shingle_sets(word_block(table.column("text").combine_chunks(), lower=True), n)
        sizes = np.diff(starts)
        _, numbers = np.unique(grams, return_inverse=True)
        held = np.zeros(len(numbers) + 1, bool)
        parent = list(range(len(ids)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        links: list[tuple[int, int]] = []
        begins = np.minimum(starts[:-1], max(len(numbers) - 1, 0))
        two = len(np.unique(tiles)) > 1
        for i in range(len(ids)):
            own = numbers[starts[i] : starts[i + 1]]
            if not len(own):
                continue
            held[own] = True
            both = np.add.reduceat(held[numbers].astype(np.int32), begins)
            held[own] = False
            linked = 100 * both.astype(np.int64) >= percent * (sizes + sizes[i] - both)
            linked[: i + 1] = False
            linked &= sizes > 0
            if two:  # pairs inside a tile belong to that tile's own task
                linked &= tiles != tiles[i]
            for j in np.flatnonzero(linked):
                a, b = find(i), find(j)
                if a != b:
                    parent[a] = b
                    links.append((int(ids[i]), int(ids[j])))
        return pa.table([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], schema=schema)

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, tile: int = TILE) -> DataFrame:
    """Components of near-duplicate documents; one row per row of ``docs`` (columns ``doc_id``, ``text``; others ignored).

    Links: the Jaccard similarity of the lower-cased ``shingle``-word sets is at least ``percent`` / 100. Returns
    ``doc_id``, ``n_shingles``, ``component_id`` (smallest doc_id reachable) and ``kept`` (doc_id = component_id).

    Null or wordless texts have the empty set and are linked with nothing. A null doc_id has a null component, links
    nothing and is kept. Rows that repeat a doc_id are texts of one document and share its component.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = staged(docs.mapInArrow(_describe(shingle, *banding(percent)), "doc_id long, n_shingles long, fp binary, bands array<long>"), "near-sets")
    real = described.filter("n_shingles > 0 and doc_id is not null")
    classes = staged(real.groupBy("fp", "bands").agg(F.min("doc_id").alias("node")), "near-classes")
    banded = classes.select("node", F.posexplode("bands").alias("band", "hash"))
    buckets = banded.groupBy("band", "hash").agg(F.min("node").alias("centre"), F.max("node").alias("last")).filter("centre < last")
    edges = banded.join(buckets.select("band", "hash", "centre"), ["band", "hash"]).select(F.col("node").alias("u"), F.col("centre").alias("v"))
    clusters = staged(connected_components(edges, "near-clusters"), "near-clusters").withColumnRenamed("component", "cluster")

    # Tile t of a cluster holds about `tile` members; a task takes tiles (i, j), i <= j.
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size")).select("cluster", F.expr(f"cast(ceil(size / {tile}) as int)").alias("tiles"))
    placed = clusters.join(sizes, "cluster").withColumn("tile", F.expr("cast(pmod(xxhash64(node), tiles) as int)"))
    both = F.expr("transform(sequence(0, tiles - 1), t -> named_struct('i', least(t, tile), 'j', greatest(t, tile)))")
    # A shuffle join at every size: the members of clusters grow with the corpus.
    texts = docs.join(placed.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id")
    tiled = texts.select("doc_id", "text", "cluster", "tile", F.explode(both).alias("at")).select("doc_id", "text", "tile", "cluster", "at.i", "at.j")
    links = staged(tiled.groupBy("cluster", "i", "j").applyInArrow(_links(shingle, percent), "u long, v long"), "near-links")

    same = staged(described.select("doc_id", "n_shingles", "fp").join(classes.select("fp", "node"), "fp", "left"), "near-rows")
    repeated = same.filter("doc_id is not null and node is not null").groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("w")).filter("v < w")
    one = same.join(repeated.select("doc_id", "v"), "doc_id").select(F.col("node").alias("u"), "v").filter("u <> v")
    components = connected_components(links.union(one), "near-components")
    found = same.join(components, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "node", "doc_id").alias("component_id"))
    return found.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
