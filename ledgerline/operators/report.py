"""Cleaning summary and stage report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_summary(sources: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """Initial, kept and excluded rows per source.

    ``sources``: ``(name, raw_df, keep_predicate)``. Each source is scanned once:
    both counts come from the same aggregate.
    """
    parts = [
        raw.agg(
            F.count(F.lit(1)).alias("nb_lignes_initiales"),
            F.count_if(pred).alias("nb_apres_nettoyage"),
        ).select(F.lit(name).alias("source"), "nb_lignes_initiales", "nb_apres_nettoyage")
        for name, raw, pred in sources
    ]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("nb_exclues", F.col("nb_lignes_initiales") - F.col("nb_apres_nettoyage"))


def stage_counts(raw: DataFrame, keep: Column, key: str, wanted: Column | None = None) -> DataFrame:
    """One row ``raw, clean, dedup`` from one pass over a source: its rows, its kept rows, and the distinct keys among
    the kept rows that meet ``wanted``. Keys are counted map-side before the shuffle."""
    kept = F.coalesce(keep, F.lit(False))
    chosen = kept if wanted is None else kept & F.coalesce(wanted, F.lit(False))
    per_key = raw.groupBy(key).agg(F.count(F.lit(1)).alias("raw"), F.count_if(kept).alias("clean"), F.count_if(chosen).alias("chosen"))
    return per_key.agg(
        F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum("clean"), F.lit(0)).alias("clean"),
        F.count_if(F.col("chosen") > 0).alias("dedup"),
    )


@dataclass(frozen=True)
class Figure:
    """One report line: its number and label, the column of a one-row figures
    DataFrame that holds the value, and the expected value as text ('' when none)."""

    step_no: int
    label: str
    column: str
    expected: str = ""


def count_figures(df: DataFrame, column: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(column))


def stage_report(groups: Sequence[tuple[DataFrame, Sequence[Figure]]]) -> DataFrame:
    """Ordered report ``step_no, etape, resultat, attendu, passed``.

    ``groups``: ``(one-row figures DataFrame, figures read from it)``. Each figures
    DataFrame is computed once whatever the number of lines it feeds. ``resultat`` is a double (counts and the amount share one column);
    ``passed`` compares it with ``attendu`` at 2 decimals; it is NULL on a line
    with no expected figure (``attendu = ''``).
    """
    parts = []
    for df, figures in groups:
        lines = []
        for fig in figures:
            v = F.col(fig.column).cast("double")
            if fig.expected == "":
                passed = F.lit(None).cast("boolean")
            else:
                passed = F.coalesce(
                    F.round(v, 2).cast("decimal(38,2)") == F.lit(fig.expected).cast("decimal(38,2)"), F.lit(False)
                )
            lines.append(
                F.struct(
                    F.lit(fig.step_no).alias("step_no"),
                    F.lit(fig.label).alias("etape"),
                    v.alias("resultat"),
                    F.lit(fig.expected).alias("attendu"),
                    passed.alias("passed"),
                )
            )
        parts.append(df.select(F.inline(F.array(*lines))))
    return reduce(lambda a, b: a.unionByName(b), parts)
