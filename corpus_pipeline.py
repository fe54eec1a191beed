"""Corpus pipeline over ``documents``: quality, near-dedup, substring dedup, decontamination, mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and reread as the next one's ``docs``. All but the last return the columns of ``documents``, extra columns
included; the last adds how each document was drawn. Each stage judges its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontam, mixing, near, quality, substr
from ledgerline.llm.shared import staged, tables

KEEP_SCORE = 0.3
ADDED = ("n_tokens", "epoch", "block", "weight")


def _columns(docs: DataFrame, of: str = "") -> list:
    return [F.col(f"{of}`{c}`") for c in docs.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least ``KEEP_SCORE``; empty texts get the prior and stay."""
    labels = tables(spark, sf_dir, "labels").filter("crc32(cast(doc_id as string)) % 5 <> 0")
    model = quality.train(docs.select("doc_id", "text"), labels)
    row = docs.select(F.struct(*_columns(docs)).alias("row"))
    scored = quality.score(row, model, text="row.text", name="score").filter(F.col("score") >= KEEP_SCORE)
    return scored.select(*_columns(docs, "row."))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate component (5-word shingles, similarity 0.8).

    Rows without a doc_id all stay. Rows that repeat doc_id and text are one document, and one of them stays.
    """
    dropped = near.near_duplicates(docs, shingle=5, percent=80).filter("not kept").select("doc_id").distinct()
    own = "own_number"
    while own in docs.columns:
        own += "_"
    apart = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())  # no two rows without an id are one document
    kept = docs.join(dropped, "doc_id", "left_anti").select(*_columns(docs), apart.alias(own))
    return kept.dropDuplicates(["doc_id", "text", own]).drop(own)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 13 words or more that an earlier document has; a text that loses every word goes.

    A text that loses nothing stays as it is; otherwise its kept words are joined by one space and n_chars is counted anew.
    """
    left = substr.remove_repeats(docs, k=13).filter("n_removed = 0 or n_removed < n_words")
    cut = F.col("n_removed") > 0
    new = {"text": F.when(cut, F.col("kept")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(cut, F.length("kept").cast(kind)).otherwise(F.col("row.n_chars"))
    return left.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``."""
    found = decontam.contamination(docs, tables(spark, sf_dir, "benchmark")).filter("contaminated").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct()
    row = docs.select(F.struct(*_columns(docs)).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64(F.coalesce(F.col("row.text"), F.lit(""))) == F.col("key"))
    return row.join(found, same, "left_anti").select(*_columns(docs, "row."))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by flattened source weights, for as many tokens as came in and no source more than twice.

    A column of the input named like one of ``ADDED`` gives way to it.
    """
    drawn = mixing.mix(docs, repetitions=2.0)
    return drawn.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in ADDED], *ADDED)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]

#: The first stage's classifier and the components of near-duplicates have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and reread."""
    docs = tables(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
