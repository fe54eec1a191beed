"""Filter interaction audit: what each filter removes under every order of the filters.

Every document gets a mask of the filters it fails, and a part of the corpus shrinks to at most ``2 ** len(FILTERS)``
cells (mask, documents, good documents, toxic documents). A Gray-code walk then visits every subset of filters by
toggling one filter at a time: each cell counts how many of the active filters it fails, and only the cells whose count
leaves or reaches zero change the running survivors. The survivors of the 32 subsets are stored, and every step of every
order is a difference of two of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import staged
from ledgerline.llm.text import bounded

FILTERS = "ABCDE"
UPPER, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
NO_ID = (1 << 63) - 1  # a row without a doc_id stands behind every other row of its text
MEASURES = ("docs", "good", "toxic")
RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_mask(text: bytes, n_chars: int) -> int:
    """Which of the filters A to D a text fails, one bit each."""
    words = text.split()  # bytes split at x20 and x09-x0D, nothing else
    n = len(words)
    short = n < 200
    repetitive = 100 * len(set(words)) < 50 * n
    loud = 100 * (len(text) - len(text.translate(None, UPPER))) > 2 * n_chars
    marked = len(text.translate(None, MARKS)) < len(text)
    return short | repetitive << 1 | loud << 2 | marked << 3


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in bounded(batches, "text"):
        texts = batch.column("text").fill_null("")
        chars = pc.utf8_length(texts).to_pylist()
        raw = texts.cast(pa.binary()).to_pylist()
        masks = [text_mask(t, n) for t, n in zip(raw, chars, strict=True)]
        keys = [hashlib.sha256(t).digest() for t in raw]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(keys, pa.binary()), pa.array(masks, pa.int32())],
            ["doc_id", "part", "text_key", "mask"],
        )


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic documents per ``part`` and ``mask`` (bit i: fails ``FILTERS[i]``).

    Rows are counted per (doc_id, part, text, mask) before anything else is shuffled, so copies of a row are one row from
    there on. Filter E compares with the smallest doc_id of the text in the whole table (a partial minimum per text); rows
    find out whether they are that first one by a join on text and doc_id together, so that a text which a third of the
    rows hold is spread by doc_id.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    judged = rows.mapInArrow(_judge, "doc_id long, part string, text_key binary, mask int")
    counted = judged.groupBy("doc_id", "part", "text_key", "mask").agg(F.count("*").alias("n"))
    counted = staged(counted.withColumn("rank", F.coalesce("doc_id", F.lit(NO_ID))), "audit-rows")
    first = counted.groupBy("text_key").agg(F.min("rank").alias("rank")).withColumn("is_first", F.lit(True))
    bit_e = F.when(F.col("is_first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    masked = counted.join(first.hint("merge"), ["text_key", "rank"], "left").withColumn("mask", F.col("mask") + bit_e)
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("bad")
    )
    known = masked.join(marks.hint("merge"), "doc_id", "left")
    return known.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("bad", F.lit(0))).alias("toxic"),
    )


def survivors(masks: np.ndarray, weights: np.ndarray, n_filters: int) -> np.ndarray:
    """Total weight of the cells that no active filter fails, for every subset of filters (row: the subset's bits).

    ``weights`` has a row per cell and a column per measure.
    """
    states = np.zeros((1 << n_filters, weights.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)  # active filters that each cell fails
    alive = weights.sum(axis=0)
    states[0] = alive
    subset = 0
    for i in range(1, 1 << n_filters):
        bit = (i & -i).bit_length() - 1  # the filter that the Gray code toggles
        subset ^= 1 << bit
        hit = (masks >> bit & 1).astype(bool)
        if subset >> bit & 1:
            alive = alive - weights[hit & (failing == 0)].sum(axis=0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            alive = alive + weights[hit & (failing == 0)].sum(axis=0)
        states[subset] = alive
    return states


def steps(states: np.ndarray, filters: str) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order."""
    n = len(filters)
    everything = (1 << n) - 1
    rows, removed_by = [], [0] * n
    for order in permutations(range(n)):
        name, before = "".join(filters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            lost = states[before] - states[after]
            fails = int(states[0][0] - states[1 << f][0])
            alone = int(states[everything ^ 1 << f][0] - states[everything][0])
            removed_by[f] += int(lost[0])
            rows.append((f, name, step, int(states[after][0]), int(lost[0]), fails - int(lost[0]), alone, int(lost[1]), int(lost[2])))
            before = after
    return [(*r[1:], removed_by[r[0]]) for r in rows]


def _report(table: pa.Table) -> pa.Table:
    masks = table.column("mask").to_numpy().astype(np.int64)
    weights = np.stack([table.column(c).to_numpy().astype(np.int64) for c in MEASURES], axis=1)
    rows = steps(survivors(masks, weights, len(FILTERS)), FILTERS)
    columns = list(zip(*rows, strict=True))
    types = [pa.string(), pa.int32(), *[pa.int64()] * 7]
    arrays = [pa.array([table.column("part")[0].as_py()] * len(rows), pa.string()), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
    return pa.Table.from_arrays(arrays, [field.split()[0] for field in RESULT.split(", ")])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every step of every order of the five filters, per part of the corpus (``docs``: doc_id, text, source).

    A: fewer than 200 words. B: 100 * distinct words < 50 * words. C: 100 * A-Z characters > 2 * code points. D: holds one
    of ``#$%&*|``. E: identical to the text of a smaller doc_id, anywhere in the table.

    Null texts are empty (they fail A; all but the first fail E); a null source is the part ''. Rows without a doc_id stand
    behind all others of their text and don't count as copies of each other; rows that repeat doc_id and text are all
    counted and aren't copies of each other. A document is good (toxic) if any of its ``labels`` rows says 1; without a row
    it is neither. Other columns of both tables are ignored. An empty table has no parts, so no rows.
    """
    return cells(docs, labels).groupBy("part").applyInArrow(_report, RESULT)
