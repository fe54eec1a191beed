import hashlib
import random
import re
import string

import pytest

from ledgerline.llm import simhash
from tests.llm.conftest import SCHEMA

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))]
    hashes = [int(hashlib.md5(g.encode()).hexdigest()[:16], 16) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows: list[tuple]) -> list[tuple]:
    """Walks the distinct (doc_id, text) in descending doc_id; rows of one doc_id in whatever order the query chose."""
    ids = sorted({(r[0], r[1] or "") for r in rows}, key=lambda x: (x[0] is not None, x[0] or 0), reverse=True)
    assert len({i for i, _ in ids}) == len(ids)
    after = dict(zip(ids, [*ids[1:], ids[0]], strict=True))
    out = []
    prints = {fingerprint(t) for _, t in ids}
    for row in rows:
        me = (row[0], row[1] or "")
        text, other, half = me[1], after[me][1], len(me[1]) // 2
        edited = text[: len(text) - half] + other[:half]
        a, b, c = fingerprint(text), fingerprint(edited), fingerprint(other)
        near = [1 - (a ^ x).bit_count() / 64 for x in (b, c)]
        crowd = sum(0 < (a ^ x).bit_count() <= 3 for x in prints)
        out.append((row[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016x}", f"{b:016x}", *near, crowd))
    return sorted(out, key=str)


def test_equals_plain_votes(spark, docs, rows):
    found = simhash.digest(simhash.edited_fingerprints(docs))
    assert found.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    one_null = [r for r in rows if r[0] is not None]
    unique = spark.createDataFrame(one_null + [rows[-2]], SCHEMA)
    assert len(got) == len(rows)
    assert sorted((tuple(r) for r in simhash.digest(simhash.edited_fingerprints(unique)).collect()), key=str) == brute(one_null + [rows[-2]])


def test_rows_of_one_id_with_different_texts(spark):
    texts = [f"text number {i} of the same document id and some more words" for i in range(300)]
    data = [(5, t) for t in texts] + [(None, None), (None, "x"), (None, ""), (7, "seven"), (-(1 << 63), "least")]
    found = simhash.digest(simhash.edited_fingerprints(spark.createDataFrame(data, "doc_id long, text string"))).collect()
    assert len(found) == len(data)
    # null and '' are one text: two rows that are one document
    assert sorted(r.fingerprint for r in found) == sorted(f"{fingerprint(t or ''):016x}" for _, t in data)
    assert sum(r.doc_id is None for r in found) == 3 and sum(r.doc_id == -(1 << 63) for r in found) == 1


def test_copies_keep_their_rows_and_a_single_document_is_its_own_next(spark):
    data = [(3, "a b c d e f g h")] * 40_000
    found = simhash.digest(simhash.edited_fingerprints(spark.createDataFrame(data, "doc_id long, text string")))
    assert found.count() == 40_000 and found.distinct().count() == 1
    row = found.first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"a b c d a b c d").hexdigest()


def test_long_texts_are_voted_in_pieces(spark):
    r = random.Random(3)
    for size in (simhash.PIECE + 4, 3 * simhash.PIECE):
        text = " ".join(str(r.randint(0, 999)) for _ in range(size))
        data = spark.createDataFrame([(1, text), (2, "same " * 2 * simhash.PIECE)], "doc_id long, text string")
        got = {x.doc_id: x.fp for x in simhash.fingerprints(data, ["doc_id"]).select("doc_id", simhash.as_hex("bits").alias("fp")).collect()}
        assert got == {1: f"{fingerprint(text):016x}", 2: f"{fingerprint('same same same same same'):016x}"}


def test_empty_table(spark, no_docs):
    found = simhash.digest(simhash.edited_fingerprints(no_docs))
    assert found.count() == 0 and found.columns[0] == "doc_id"
    assert simhash.within(spark.createDataFrame([], "bits long")).count() == 0


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("radius,blocks", [(1, None), (3, None), (3, 4), (6, 8)])
def test_block_tables_find_every_pair_within_the_radius_once(spark, radius, blocks):
    r = random.Random(radius)
    prints = [r.getrandbits(64) for _ in range(60)]
    for _ in range(300):  # chains and crowds around some of them
        flips = r.sample(range(64), r.randint(0, radius + 2))
        prints.append(r.choice(prints[:8] + prints[-5:]) ^ sum(1 << f for f in flips))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = [(p, "x", "y") for p in signed] + [(None, "x", "y")]
    table = spark.createDataFrame(rows, "bits long, part string, lead string")
    got = [tuple(x) for x in simhash.within(table, radius, blocks).collect()]
    distinct = sorted(set(signed))
    expected = {(a, b, ((a ^ b) & (1 << 64) - 1).bit_count()) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius}
    assert len(got) == len(set(got)) and set(got) == expected and len(expected) > 50


def test_no_python_in_the_plan(spark, docs):
    plan = simhash.fingerprints(docs.select("doc_id", "text"), ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
