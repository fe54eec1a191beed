"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``ORDER`` bytes. In a context seen n times with u different next
bytes, a byte seen c times has probability c / (n + u) and the escape u / (n + u); an escape goes on to the context
shortened by one byte, and below the empty context every byte has 1 / 256. The statistics are frozen after training.
A text's code length under a language is the exact sum over its bytes (lower-cased, UTF-8), with ``ORDER`` line feeds
thought before its beginning; the shortest code wins.

Scoring is one map over whole texts. The trees are flattened into one table for all languages: a number for the longest
context seen in any language, and for each number and byte the code length in every language.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.shared import staged

ORDER = 3
SAMPLE_ROWS = 400  # training texts of a language, at most
SAMPLE_CHARS = 100_000  # code points of a training text, at most
CHUNK = 1 << 20  # bytes scored at once
START = b"\n" * ORDER


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each behind ``START``, as one byte array, and where each begins (one more offset than texts)."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    joined = pc.binary_join_element_wise(pa.scalar(START, pa.large_binary()), texts, pa.scalar(b"", pa.large_binary()))
    lengths = pc.binary_length(joined).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return np.frombuffer(joined.buffers()[2] or b"", np.uint8)[: starts[-1]], starts


def count_grams(texts: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each context length, the (context, byte) pairs as numbers in base 256, and how often each occurs."""
    data, starts = _bytes(texts)
    real = np.ones(len(data), bool)
    for i in range(ORDER):
        real[starts[:-1] + i] = False
    at = np.flatnonzero(real)
    out = {}
    for n in range(ORDER + 1):
        gram = np.zeros(len(at), np.int64)
        for i in range(n, -1, -1):
            gram = gram * 256 + data[at - i]
        out[n] = np.unique(gram, return_counts=True)
    return out


def _fit(table: pa.Table) -> pa.Table:
    grams = count_grams(table.column("text").combine_chunks())
    return pa.table({"lang": [table.column("lang")[0].as_py()], "grams": pa.array([pickle.dumps(grams)], pa.binary())})


class Model:
    """Code lengths of all languages in one table."""

    def __init__(self, trained: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]]) -> None:
        self.langs = sorted(trained)
        seen = sorted({*START, *(int(g) for grams in trained.values() for g in grams[0][0])})
        self.symbol = np.zeros(256, np.int32)  # 0: a byte that no language has
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        a = self.size = len(seen) + 1
        levels = []
        for n in range(ORDER + 1):
            contexts = np.unique(np.concatenate([g[n][0] >> 8 for g in trained.values()] or [np.zeros(0, np.int64)]))
            levels.append(contexts)
        # numbers of contexts, by length; `longest` maps ORDER symbols to the longest known context
        first = np.concatenate([[0], np.cumsum([len(x) for x in levels])])
        self.longest = np.zeros(a**ORDER, np.int32)
        for n in range(1, ORDER + 1):
            index = np.zeros(len(levels[n]), np.int64)
            for i in range(n - 1, -1, -1):
                index = index * a + self.symbol[(levels[n] >> (8 * i)) & 255]
            view = self.longest.reshape(a ** (ORDER - n), a**n)
            view[:, index] = np.arange(first[n], first[n] + len(levels[n]), dtype=np.int32)
        cost = np.zeros((max(int(first[-1]), 1), a, len(self.langs)), np.float32)
        for k, lang in enumerate(self.langs):
            below = np.full((1, a), 8.0)
            for n in range(ORDER + 1):
                grams, counts = trained[lang][n]
                contexts = levels[n]
                parent = np.zeros(len(contexts), np.int64) if n == 0 else np.searchsorted(levels[n - 1], contexts & ((1 << 8 * (n - 1)) - 1))
                rows = np.searchsorted(contexts, grams >> 8)
                total = np.bincount(rows, counts, len(contexts))
                kinds = np.bincount(rows, minlength=len(contexts))
                with np.errstate(divide="ignore", invalid="ignore"):
                    escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
                own = below[parent] + escape[:, None]
                own[rows, self.symbol[grams & 255]] = np.log2((total + kinds)[rows] / counts)
                cost[first[n] : first[n + 1], :, k] = own
                below = own
        self.flat = cost.reshape(-1, len(self.langs)) if self.langs else np.zeros((1, 0), np.float32)

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Code length in bits of each text in each language."""
        data, starts = _bytes(texts)
        out = np.zeros((len(starts) - 1, len(self.langs)))
        a = self.size
        for begin in range(0, len(data), CHUNK):
            end = min(begin + CHUNK, len(data))
            s = self.symbol[data[max(begin - ORDER, 0) : end]]
            if begin < ORDER:
                s = np.concatenate([np.zeros(ORDER - begin, np.int32), s])
            m = end - begin
            context = np.zeros(m, np.int32)
            for i in range(ORDER):
                context = context * a + s[i : i + m]
            at = self.longest[context] * np.int32(a) + s[ORDER:]
            low = int(np.searchsorted(starts, begin, "right")) - 1
            high = int(np.searchsorted(starts, end, "left"))
            for row_start in starts[low:high]:
                if begin - ORDER < row_start:  # the bytes thought before a text cost nothing
                    at[max(row_start - begin, 0) : max(row_start + ORDER - begin, 0)] = -1
            costs = self.flat[at]
            costs[at < 0] = 0
            cuts = np.maximum(starts[low:high] - begin, 0)
            out[low:high] += np.add.reduceat(costs, cuts, axis=0, dtype=np.float64)
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        lengths = self.lengths(texts)
        best = lengths.argmin(axis=1)
        share = 1.0 / np.exp2(np.maximum(-(lengths - lengths.min(axis=1, keepdims=True)), -1000)).sum(axis=1)
        return [self.langs[i] for i in best], share


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` texts of each language (those with the smallest hash of their doc_id).

    ``docs``: ``doc_id``, ``text``, ``lang``; rows without a language or text, and texts of more than ``SAMPLE_CHARS`` code
    points, teach nothing. A doc_id that repeats is one entry of the sample and teaches one text (smallest hash).
    """
    rows = docs.filter("lang is not null and text is not null and doc_id is not null").select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    usable = rows.filter(F.length("text") <= SAMPLE_CHARS)
    # every task keeps its own first rows of a language (WindowGroupLimit), so no task sorts a whole language
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    distinct = usable.select("doc_id", "lang").distinct()
    chosen = staged(distinct.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample_rows).select("doc_id", "lang"), "langid-sample")
    texts = usable.join(chosen, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
    fitted = texts.select("lang", F.lower("first.text").alias("text")).groupBy("lang").applyInArrow(_fit, "lang string, grams binary")
    return Model({r.lang: pickle.loads(r.grams) for r in fitted.collect()})


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``language`` (in place of an input column of that name): ``lang_pred`` and ``score``.

    ``lang_pred`` is the language with the shortest code (the first in name order on a tie), ``score`` its posterior
    probability under equal priors. A text that is null or has no letter is ``und`` with score 0, as is every text if
    no language was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))  # bounded: at most A^3 contexts of a sample of bounded rows

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = cloudpickle.loads(shared.value)
        for texts in batches:
            if own.langs:
                langs, scores = own.predict(texts)
            else:
                langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    def letters(column: Column) -> Column:
        return F.coalesce(column.rlike(r"\p{L}"), F.lit(False))

    whole = F.col(text).cast("string")
    found = predict(F.lower(whole))
    nothing = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return docs.withColumn("language", F.when(letters(whole), found).otherwise(nothing))
