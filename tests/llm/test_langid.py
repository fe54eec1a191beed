import math
import random

import pyarrow as pa
import pytest

from ledgerline.llm import langid

ALPHABETS = {"aa": "abcde ", "bb": "defgh ", "cc": "éàüabc "}


def text(r, lang, n):
    return "".join(r.choice(ALPHABETS[lang]) for _ in range(n))


def trained(r):
    return {lang: [text(r, lang, 60) for _ in range(8)] for lang in ALPHABETS}


def brute_length(texts, sample):
    """Code length by walking the context tree byte by byte."""
    seen = {}
    for t in texts:
        b = langid.START + t.encode()
        for i in range(langid.ORDER, len(b)):
            for n in range(langid.ORDER + 1):
                own = seen.setdefault(b[i - n : i], {})
                own[b[i]] = own.get(b[i], 0) + 1
    bits, b = 0.0, langid.START + sample.encode()
    for i in range(langid.ORDER, len(b)):
        for n in range(langid.ORDER, -1, -1):
            own = seen.get(b[i - n : i])
            if own is None:
                continue
            total = sum(own.values()) + len(own)
            if b[i] in own:
                bits -= math.log2(own[b[i]] / total)
                break
            bits -= math.log2(len(own) / total)
        else:
            bits += 8
    return bits


def test_code_lengths_match_brute_force(monkeypatch):
    r = random.Random(3)
    texts = trained(r)
    model = langid.Model({lang: langid.count_grams(pa.array(t)) for lang, t in texts.items()})
    samples = [text(r, lang, n) for lang in ALPHABETS for n in (0, 1, 2, 3, 50)] + ["zzz \x00 ß", "é" * 30]
    want = [[brute_length(texts[lang], s) for lang in model.langs] for s in samples]
    for chunk in (1 << 20, 7, 1):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        got = model.lengths(pa.array(samples))
        for a, b in zip(got, want, strict=True):
            assert list(a) == pytest.approx(b, rel=1e-5, abs=1e-4)


def test_probabilities_of_a_context_sum_to_at_most_one():
    r = random.Random(4)
    model = langid.Model({"aa": langid.count_grams(pa.array([text(r, "aa", 300)]))})
    p = 2.0 ** -model.flat.reshape(-1, model.size)
    assert (p[:, 1:].sum(axis=1) <= 1 + 1e-6).all()


def test_held_out_accuracy_and_awkward_rows(spark):
    r = random.Random(5)
    rows = [(i, text(r, lang, r.randint(30, 200)), lang) for i, lang in enumerate(list(ALPHABETS) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs.filter("doc_id % 5 <> 0"))
    odd = [(None, "abc abd eda", None), (500, None, None), (501, "", None), (502, "12 34 !!", None), (503, "ab " * 200_000, None), (503, "ab", None)]
    found = langid.identify(spark.createDataFrame(rows + odd, "doc_id long, text string, lang string"), model).collect()
    held = [x for x in found if x.doc_id is not None and x.doc_id < 500 and x.doc_id % 5 == 0]
    assert sum(x.language.lang_pred == x.lang for x in held) / len(held) >= 0.97
    assert all(0 <= x.language.score <= 1 for x in found) and len(found) == len(rows) + len(odd)
    by = {x.text: x.language for x in found}
    assert by[None].lang_pred == by[""].lang_pred == by["12 34 !!"].lang_pred == "und" and by[None].score == 0
    assert by["ab " * 200_000].lang_pred == "aa"


def test_nothing_learned_and_empty_table(docs, no_docs):
    model = langid.train(no_docs)
    assert {r.language.lang_pred for r in langid.identify(docs, model).collect()} == {"und"}
    assert langid.identify(no_docs, model).collect() == []


def test_a_doc_id_that_repeats_is_one_entry_of_the_sample(spark, monkeypatch):
    r = random.Random(6)
    rows = [(i, text(r, "aa", 40), "aa") for i in range(60)] + [(1000, text(r, "aa", 20), "aa") for _ in range(500)] + [(2000 + i, "zz " * 60_000, "aa") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fitted = []
    monkeypatch.setattr(langid, "Model", lambda by: fitted.append(by))
    langid.train(docs, 61)
    langid.train(docs.filter("doc_id < 1000"), 60)
    own, less = (int(f["aa"][0][1].sum()) for f in fitted)  # bytes counted
    assert 0 < own - less < 2 * max(len(t) for i, t, _ in rows if i == 1000)  # one of the 500 texts, none of the long ones
