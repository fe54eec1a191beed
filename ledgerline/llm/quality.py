"""Quality classifier: nearest labelled neighbours in a latent-semantic space.

Terms of a text are its words (hashed) and the shapes of neighbouring words (letter cases, digits and signs, and whether
a word repeats the one before). Their log counts, weighted by rarity, are projected on the leading singular vectors of
a bounded labelled sample. Every document's vector is compared with all labelled vectors (exact cosine products, block
by block), and its ``NEIGHBOURS`` nearest vote for their label, weighted by similarity.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import staged
from ledgerline.llm.text import WordBlock, give_back, pieces, word_block

SAMPLE_ROWS = 1500  # labelled texts of each label, at most
WORD_TERMS, SHAPE_TERMS = 4096, 2048
DIMENSIONS = 48
NEIGHBOURS = 21
BLOCK = 256  # documents whose counts are held at once

_SHAPES = (re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"(\W)\1+"))


def _shape(word: str) -> str:
    letters = _SHAPES[0].sub(lambda m: "X" if len(m[0]) > 1 and m[0].isupper() else "C" if m[0][0].isupper() else "x", word)
    return _SHAPES[2].sub(r"\1\1", _SHAPES[1].sub("9", letters))


class Terms:
    """Term numbers of the words of a block."""

    def __init__(self, block: WordBlock) -> None:
        words = block.words.to_pylist()
        self.starts = block.starts
        lower = np.fromiter((xxhash.xxh3_64_intdigest(w.lower()) % WORD_TERMS for w in words), np.int64, len(words))
        shape = np.fromiter((xxhash.xxh3_64_intdigest(_shape(w)) & 0xFFFFFFFF for w in words), np.uint64, len(words))
        codes = block.codes
        self.words = lower[codes]
        own = shape[codes]
        before = np.concatenate([[np.uint64(0)], own[:-1]])
        before[block.starts[:-1][block.starts[:-1] < len(own)]] = 0
        same = np.zeros(len(codes), np.uint64)
        same[1:] = codes[1:] == codes[:-1]
        mixed = (own * np.uint64(0x9E3779B97F4A7C15) + before * np.uint64(0xC2B2AE3D27D4EB4F) + same * np.uint64(0x165667B19E3779F9)) >> np.uint64(40)
        self.shapes = WORD_TERMS + (mixed % np.uint64(SHAPE_TERMS)).astype(np.int64)

    def counts(self, first: int, last: int) -> np.ndarray:
        """Log counts of the texts ``first`` to ``last`` - 1, a row each."""
        width = WORD_TERMS + SHAPE_TERMS
        a, b = self.starts[first], self.starts[last]
        row = np.repeat(np.arange(last - first) * width, np.diff(self.starts[first : last + 1]))
        raw = np.bincount(np.concatenate([row + self.words[a:b], row + self.shapes[a:b]]), minlength=(last - first) * width)
        return np.log1p(raw.astype(np.float32)).reshape(last - first, width)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _fit(table: pa.Table) -> pa.Table:
    """Singular vectors and labelled vectors of the sample (a bounded number of rows)."""
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    terms = Terms(word_block(table.column("text").combine_chunks()))
    x = terms.counts(0, table.num_rows)
    rarity = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 0.1
    x *= rarity
    x = _unit(x)
    random = np.random.default_rng(11)
    y = x @ random.standard_normal((x.shape[1], DIMENSIONS + 16)).astype(np.float32)
    for _ in range(3):  # subspace iteration
        q, _ = np.linalg.qr(y)
        y = x @ (x.T @ q)
    q, _ = np.linalg.qr(y)
    _, _, v = np.linalg.svd(q.T @ x, full_matrices=False)
    projection = (v[:DIMENSIONS].T * rarity[:, None]).astype(np.float32)
    vectors = _unit(terms.counts(0, table.num_rows) @ projection)
    model = {"projection": projection, "vectors": vectors, "labels": table.column("quality").to_numpy(), "weights": table.column("weight").to_numpy()}
    return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict | None:
    """Fit on at most ``sample_rows`` labelled texts of each label (smallest hash of doc_id); None without any.

    A sampled text votes for as many labelled texts of its label as it stands for. Labels other than 0 and 1, null
    doc_ids and null texts teach nothing; rows that repeat a doc_id in ``labels`` count once, with the lowest label, and of
    the texts that share a doc_id one teaches (smallest hash).
    """
    have = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    usable = staged(known.join(have.distinct(), "doc_id", "left_semi"), "quality-labels")
    # the first rows of each label by hash: every task keeps its own first rows, so no task sorts a whole label
    some, other = (usable.filter(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows) for label in (0, 1))
    some = some.unionByName(other)
    totals = usable.groupBy("quality").agg(F.count("*").alias("total")).withColumn("weight", F.expr(f"cast(greatest(total, 1) as double) / least(total, {int(sample_rows)})"))
    chosen = staged(some.join(totals.select("quality", "weight"), "quality"), "quality-sample")
    texts = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    # a doc_id that repeats gives one text, however many rows it has
    texts = texts.groupBy("doc_id", "quality", "weight").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")).select("doc_id", "quality", "weight", F.col("first.text").alias("text"))
    fitted = texts.groupBy(F.lit("all").alias("sample")).applyInArrow(_fit, "model binary").collect()
    return pickle.loads(fitted[0].model) if fitted else None


def score_texts(model: dict, texts: pa.Array) -> np.ndarray:
    return np.concatenate([np.empty(0), *(_score_block(model, texts.slice(a, b - a)) for a, b in pieces(texts))])


def _score_block(model: dict, texts: pa.Array) -> np.ndarray:
    terms = Terms(word_block(texts))
    labels, weights = model["labels"] == 1, model["weights"]
    prior = float(weights[labels].sum() / weights.sum())
    k = min(NEIGHBOURS, len(labels))
    out = np.full(len(texts), prior)
    for first in range(0, len(texts), BLOCK):
        last = min(first + BLOCK, len(texts))
        vectors = _unit(terms.counts(first, last) @ model["projection"])
        near = vectors @ model["vectors"].T
        best = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < near.shape[1] else np.broadcast_to(np.arange(near.shape[1]), near.shape)
        votes = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(np.float64) ** 4 * weights[best]
        total = votes.sum(axis=1)
        own = (votes * labels[best]).sum(axis=1)
        out[first:last] = np.where(total > 1e-9, own / np.maximum(total, 1e-9), prior)
    return np.clip(out, 0.0, 1.0)


def score(docs: DataFrame, model: dict | None, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the likelihood (0 to 1) that a text has label 1.

    Empty and null texts have no terms and get the share of label 1 among the labelled texts; without a model every
    score is 0.5.
    """
    if model is None:
        return docs.withColumn(name, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: 2 * SAMPLE_ROWS vectors and one projection

    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for texts in batches:
            yield pa.array(score_texts(own, texts), pa.float64())
            give_back()

    return docs.withColumn(name, judge(F.col(text).cast("string")))
