import hashlib
import itertools
import re

from pyspark.sql import functions as F

from ledgerline.llm import audit
from tests.llm.conftest import SCHEMA

LABELS = "doc_id long, quality int, toxic int, text string, mask int"


def fails(text: str) -> set[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 200:
        out.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    return out


def brute(rows: list[tuple], labels: list[tuple]) -> set[tuple]:
    """Applies every order of the filters to the documents themselves, step by step."""
    docs = []
    for doc_id, text, _, source, *_ in rows:
        mine = text or ""
        f = fails(mine)
        if any((r[1] or "") == mine and r[0] is not None and (doc_id is None or r[0] < doc_id) for r in rows):
            f.add("E")
        good = any(x[0] == doc_id and x[1] == 1 for x in labels if doc_id is not None)
        toxic = any(x[0] == doc_id and x[2] == 1 for x in labels if doc_id is not None)
        docs.append((source or "", f, good, toxic))
    out = []
    for part in {d[0] for d in docs}:
        for order in itertools.permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                failing = [d for d in docs if d[0] == part and name in d[1]]
                left = [d for d in left if name not in d[1]]
                out.append([part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), sum(d[1] == {name} for d in failing), sum(d[2] for d in gone), sum(d[3] for d in gone)])
    share = {}
    for r in out:
        share[r[0], r[1][r[2] - 1]] = share.get((r[0], r[1][r[2] - 1]), 0) + r[4]
    return {(*r, share[r[0], r[1][r[2] - 1]]) for r in out}


def marked(rows: list[tuple]) -> list[tuple]:
    ids = sorted({r[0] for r in rows if r[0] is not None})
    labels = [(i, (i // 3) % 2, int(i % 9 == 0), "x", 7) for i in ids if i % 2]
    return [*labels, (ids[5], None, None, "x", 7), (ids[6], 0, 1, "x", 7), (ids[6], 1, 0, "x", 7), (None, 1, 1, "x", 7)]


def test_every_order_equals_filters_applied_one_by_one(spark, docs, rows):
    loud = [(900 + i, t, "en", s, 0, 1.0, 1, "r", 1, 1, 1, 1, 1) for i, (t, s) in enumerate([("SHOUT " * 300, "mid"), ("a#b " * 5, ""), ("$ " + "w%d " * 250, "big"), (" ".join(f"w{i}" for i in range(250)), "mid"), (" ".join(f"w{i}" for i in range(250)), "big"), (" ".join(f"V{i}" for i in range(250)), "mid")])]
    every = rows + loud
    found = audit.audit(docs.union(spark.createDataFrame(loud, SCHEMA)), spark.createDataFrame(marked(every), LABELS))
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(every, marked(every))


def test_all_120_orders_of_every_part(spark, docs, rows):
    found = audit.audit(docs, spark.createDataFrame([], LABELS))
    parts = {r[3] or "" for r in rows}
    counts = {r.part: (r.n, r.orders) for r in found.groupBy("part").agg(F.count("*").alias("n"), F.countDistinct("filter_order").alias("orders")).collect()}
    assert counts == {p: (600, 120) for p in parts}
    assert found.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_empty_table(spark, no_docs):
    found = audit.audit(no_docs, spark.createDataFrame([], LABELS))
    assert found.count() == 0
    assert found.columns == [f.split()[0] for f in audit.RESULT.split(", ")]


def test_mask_of_whole_long_text(spark):
    words = [f"w{i}" for i in range(60_000)]
    long = " ".join(words + ["|"])
    assert audit.text_mask(long.encode(), len(long)) == 8
    assert audit.text_mask(" ".join(words * 3).encode(), 10**9) == 2
    assert audit.text_mask(b"", 0) == 1
    key = hashlib.sha256(long.encode()).digest()
    rows = spark.createDataFrame([(1, long, None), (2, long, "s")], "doc_id long, text string, source string")
    kept = audit.cells(rows, spark.createDataFrame([], LABELS)).collect()
    assert {(r.part, r["mask"], r.docs) for r in kept} == {("", 8, 1), ("s", 24, 1)} and len(key) == 32


def test_a_shared_text_is_compared_table_wide(spark):
    rows = [(i, "same text", f"s{i % 7}") for i in range(3000)]
    cells = audit.cells(spark.createDataFrame(rows, "doc_id long, text string, source string"), spark.createDataFrame([], LABELS)).collect()
    assert sum(r.docs for r in cells if not r["mask"] & 16) == 1 and sum(r.docs for r in cells) == 3000
