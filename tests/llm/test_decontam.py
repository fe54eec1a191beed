import hashlib
import re

from ledgerline.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - 12, 1) if w else 0):
            wins.setdefault(tuple(w[i : i + 13]), set()).add(item)
    out = []
    for r in rows:
        w, hit, ids = words(r[1]), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if found := wins.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    ids |= {str(x) for x in found if x is not None}
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((r[0], len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def items_of(rows):
    passage, base = rows[16][1].split(), rows[6][1]
    return [(1, " ".join(passage[20:50])), (2, base.upper()), (2, base), (10, "Two-words"), (3, "one"), (None, " ".join(passage[22:40])), (4, None), (5, "..."), (6, "same " * 20), (7, "ÉÀ ÉÀ")]


def test_matches_brute_force(spark, docs, rows):
    items = items_of(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in decontam.digest(decontam.contamination(docs, bench)).collect()), key=str)
    assert got == brute(rows, items)


def test_empty_tables(spark, docs, no_docs, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame(items_of(rows), "item_id long, text string")
    assert decontam.contamination(no_docs, bench).collect() == []
    got = sorted((tuple(r) for r in decontam.digest(decontam.contamination(docs, none)).collect()), key=str)
    assert got == brute(rows, [])


def test_main_path_has_no_python(spark, docs, rows):
    bench = spark.createDataFrame(items_of(rows), "item_id long, text string")
    plan = decontam.digest(decontam.contamination(docs, bench))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_texts_without_a_place_are_split_once(spark, docs, rows, monkeypatch):
    plans = {}
    write = decontam.staged
    monkeypatch.setattr(decontam, "staged", lambda df, label: plans.setdefault(label, df) and write(df, label))
    bench = spark.createDataFrame(items_of(rows), "item_id long, text string")
    result = decontam.contamination(docs, bench)
    assert "regexp_extract_all" not in result._jdf.queryExecution().optimizedPlan().toString()
    judged = plans["decontam-judged"]._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in judged and judged.index("regexp_extract_all") < judged.index("LeftSemi")
    places = plans["decontam-places"]._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in places  # shingles are hashed in generated code, not one by one in a lambda
