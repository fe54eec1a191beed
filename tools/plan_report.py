"""Summarise the physical plan of every registered query into PLANS.md.

    python tools/plan_report.py [/root/testdata/sf0.01]

Per query: scans (columns read, filters pushed), exchanges, join and aggregate
operators, group limits and subqueries, from ``explain("formatted")`` of the
plan Spark would run (before AQE re-planning).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(plan: str) -> dict:
    heads = re.findall(r"^\((\d+)\) (\w+)", plan, flags=re.M)
    kinds = [k for _, k in heads]
    scans = []
    for block in re.split(r"\n(?=\(\d+\) )", plan):
        if re.match(r"\(\d+\) Scan", block):
            loc = re.search(r"Location: \w+ \[([^\]]+)\]", block)
            table = os.path.basename(loc.group(1)).replace(".parquet", "") if loc else "?"
            rs = re.search(r"ReadSchema: struct<(.*)>", block)
            cols = [c.split(":")[0] for c in re.split(r",(?![^<]*>)", rs.group(1))] if rs and rs.group(1) else []
            pf = re.search(r"PushedFilters: \[(.*)\]", block)
            scans.append((table, len(cols), pf.group(1) if pf else ""))
    ex = re.findall(r"Arguments: (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)
    return {
        "scans": scans,
        "exchanges": ex,
        "joins": sorted({k for k in kinds if "Join" in k or "NestedLoop" in k or k == "CartesianProduct"}),
        "aggs": sorted({k for k in kinds if k.endswith("Aggregate")}),
        "group_limit": "WindowGroupLimit" in kinds,
        "window": "Window" in kinds,
        "subqueries": plan.count("Subquery:"),
        "python": sorted({k for k in kinds if "Python" in k or "Arrow" in k}),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from ledgerline.plans.catalog import QUERIES
    from ledgerline.session import build_session

    spark = build_session(master="local[2]", shuffle_partitions=8)
    lines = [
        "# Physical plans of the registered queries of the reconciliation chain",
        "",
        f"Generated by `python tools/plan_report.py {sf_dir}` from `explain(\"formatted\")` (the plan before AQE",
        "re-planning; AQE may still turn a sort-merge join into a broadcast join, or coalesce or split partitions, from",
        "measured sizes). Scans list `table(columns read)` and the filters pushed into the Parquet reader.",
        "Stage-writing queries (`snapshot_roundtrip`, `stage_report`, `csv_landing`, the other round trips) show the plan of their last",
        "read; their writes run as separate jobs.",
        "",
        "| query | scans (cols) · pushed filters | exchanges | joins | aggregates | other |",
        "|---|---|---|---|---|---|",
    ]
    for name in sorted(QUERIES):
        s = summarise(formatted(QUERIES[name](spark, sf_dir)))
        scans = "<br>".join(f"{t}({n})" + (f" · `{pf}`" if pf else "") for t, n, pf in s["scans"])
        exch = "<br>".join(s["exchanges"]) or "none"
        other = []
        if s["group_limit"]:
            other.append("WindowGroupLimit")
        if s["window"]:
            other.append("Window")
        if s["subqueries"]:
            other.append(f"{s['subqueries']} scalar subquery")
        other += s["python"]
        lines.append(
            f"| `{name}` | {scans} | {exch} | {', '.join(s['joins']) or '—'} | {', '.join(s['aggs']) or '—'} | "
            f"{', '.join(other) or '—'} |"
        )
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    print(f"wrote {out}")


if __name__ == "__main__":
    main(sys.argv)
