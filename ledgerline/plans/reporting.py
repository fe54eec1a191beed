"""The 13-line stage report, assembled from as few passes as possible.

* raw, cleaned and deduplicated counts of a source: one scan, keys counted before the shuffle;
* fused rows, revenue rows and revenue total: one pass over the fused table;
* outliers: one count over the classified rows of the fused table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerline.operators import metrics, report

# The report's step labels, in report order.
REPORT_LABELS = [
    "Brut - ERP",
    "Brut - Web",
    "Brut - Liaison",
    "Nettoyé - ERP",
    "Nettoyé - Web",
    "Nettoyé - Liaison",
    "Dédoublonné - ERP",
    "Dédoublonné - Web",
    "Dédoublonné - Liaison",
    "Fusion finale",
    "Produits CA",
    "CA Total (€)",
    "Vins Millésimés",
]
# Which acceptance figure each line is checked against ('' -> none).
REPORT_EXPECTED_KEYS = [
    "", "", "",
    "erp_clean", "", "",
    "erp_dedup", "", "",
    "fused", "revenue_rows", "revenue_total",
    "outliers",
]


def _exp(expected: dict, i: int) -> str:
    key = REPORT_EXPECTED_KEYS[i]
    return str(expected.get(key, "")) if key else ""


def _fig(i: int, column: str, expected: dict) -> report.Figure:
    return report.Figure(i + 1, REPORT_LABELS[i], column, _exp(expected, i))


def stage_report(
    sources: Sequence[DataFrame],
    fused: DataFrame,
    instock_status: str,
    outliers: DataFrame,
    expected: dict | None = None,
) -> DataFrame:
    """``sources``: one row ``raw, clean, dedup`` each for erp, web, liaison (``report.stage_counts``); ``outliers`` are
    those of the fused table. ``expected``: figures that the caller knows."""
    expected = expected or {}
    groups = []
    for i, counts in enumerate(sources):
        groups.append((counts, [_fig(i, "raw", expected), _fig(3 + i, "clean", expected), _fig(6 + i, "dedup", expected)]))
    ff = metrics.fused_figures(fused, instock_status)
    groups.append(
        (ff, [_fig(9, "fused_rows", expected), _fig(10, "revenue_rows", expected), _fig(11, "revenue_total", expected)])
    )
    groups.append((report.count_figures(outliers), [_fig(12, "n", expected)]))
    return report.stage_report(groups).orderBy("step_no")  # 13 rows
