import hashlib
import random
import re

import numpy as np

from ledgerline.llm import substr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k):
    split = [(r[0], WORD.findall(r[1] or "")) for r in rows]
    first = {}
    for doc, words in split:
        for i in range(len(words) - k + 1):
            if doc is not None:
                g = tuple(words[i : i + k])
                first[g] = min(first.get(g, doc), doc)
    out = []
    for doc, words in split:
        gone = set()
        for i in range(len(words) - k + 1):
            if doc is not None and first[tuple(words[i : i + k])] < doc:
                gone |= set(range(i, i + k))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs, k):
    rows = substr.remove_repeats(docs, k).select("row.doc_id", "n_words", "n_removed", "kept").collect()
    return sorted(((r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in rows), key=str)


def test_matches_brute_force(docs, rows):
    for k in (13, 4, 1):
        assert found(docs, k) == brute(rows, k)


def test_common_minimisers_change_nothing(docs, rows, monkeypatch):
    monkeypatch.setattr(substr, "_common", lambda k: _all_common(k))
    assert found(docs, 13) == brute(rows, 13)


def _all_common(k):
    import pyarrow as pa

    from ledgerline.llm.substr import _minimisers, bounded, word_block

    def run(batches):
        for batch in bounded(batches, "text"):
            _, low, _ = _minimisers(word_block(batch.column("text")), k)
            values, counts = np.unique(low, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["low", "n"])

    return run


def test_texts_under_one_id_stay_apart(spark):
    r = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    rows = [(0, " ".join(passage))]
    for i in range(3000):
        own = [f"t{i}x{j}" for j in range(r.randint(0, 30))]
        at, a, n = r.randint(0, len(own)), r.randint(0, 20), r.choice((0, 12, 13, 20))
        rows.append((7, " ".join([*own[:at], *passage[a : a + n], *own[at:]])))
    rows += [(8 + i, f"only these words of document {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(docs, 13) == brute(rows, 13)


def test_extra_columns_survive(docs):
    assert substr.remove_repeats(docs).select("row.*").columns == docs.columns


def test_empty_table(no_docs):
    assert substr.remove_repeats(no_docs).collect() == []


def test_packed_integers():
    for kind in (np.int16, np.int32, np.int64, np.uint64):
        x = np.arange(1000).astype(kind)
        assert (substr.unpack_ints(substr.pack_ints(x), kind) == x).all()
    assert len(substr.unpack_ints(b"", np.int64)) == 0


def test_common_passage_is_one_range_a_document(spark, monkeypatch):
    r = random.Random(6)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([*(f"a{i}x{j}" for j in range(r.randint(0, 9))), *passage, *(f"b{i}x{j}" for j in range(r.randint(0, 9)))])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = []
    write = substr.staged
    monkeypatch.setattr(substr, "staged", lambda df, label: kept.append(write(df, label)) or kept[-1])
    assert found(docs, 13) == brute(rows, 13)
    assert kept[0].count() < 3 * len(rows)  # 48 windows a document
