import os

import pytest

import corpus_pipeline as p
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import test_decontam, test_near, test_substr


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, rows):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(0, 1), (3, 1), (9, 1), (18, 1)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(test_decontam.items_of(rows), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def plain(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_keep_columns_and_match_brute_force(spark, docs, rows, folder):
    kept = p.keep_quality(spark, docs, folder)
    assert kept.schema == docs.schema and kept.count() == len(rows)  # only good labels: nothing goes

    got = p.drop_near_duplicates(spark, docs, folder)
    assert got.schema == docs.schema
    gone = {d for d, _, _, keep in test_near.brute(rows, 5, 80) if not keep}
    assert plain(got) == sorted({(r[0], r[1]) for r in rows if r[0] not in gone}, key=str)

    got = p.cut_repeats(spark, docs, folder)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in docs.schema]
    counts = {(d, n): (removed, digest) for d, n, removed, digest in test_substr.brute(rows, 13)}
    left = [(r[0], r[1]) for r in rows if (x := counts[r[0], len(test_substr.WORD.findall(r[1] or ""))])[0] == 0]
    assert set(left) <= set(plain(got))
    assert all(r.n_chars == len(r.text) for r in got.collect() if r.text is not None and r.doc_id is not None)
    assert got.count() == sum(x[2] == 0 or x[2] < x[1] for x in test_substr.brute(rows, 13))

    got = p.drop_contaminated(spark, docs, folder)
    assert got.schema == docs.schema
    bad = {(d, n) for d, n, _, _, _, c in test_decontam.brute(rows, test_decontam.items_of(rows)) if c}
    assert plain(got) == sorted(((r[0], r[1]) for r in rows if (r[0], len(test_decontam.words(r[1]))) not in bad), key=str)

    got = p.mix_sources(spark, docs, folder)
    assert got.columns == [c for c in docs.columns if c not in p.ADDED] + list(p.ADDED)


def test_stages_take_an_empty_table(spark, no_docs, folder):
    for _, stage in p.STAGES:
        assert stage(spark, no_docs, folder).collect() == []


def test_run_ends_clean(spark):
    drawn = p.run(spark, SF_SMALL)
    columns = spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns
    assert drawn.columns == columns + list(p.ADDED)
    rows = drawn.collect()
    assert rows and len({(r.doc_id, r.epoch) for r in rows}) == len(rows)
    texts = [(r.doc_id, r.text) for r in rows if r.epoch == 1]
    assert all(keep for *_, keep in test_near.brute(texts, 5, 80))


def test_registered():
    assert len(p.STAGES) == 5 and p.ORACLE_SQL is None
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert os.path.exists(SF_SMALL)


def test_rows_without_a_doc_id_all_stay(spark):
    rows = [(None, None, "a"), (None, None, "b"), (None, "same text", "a"), (None, "same text", "a"), (1, "same text", "x"), (1, "same text", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own_number string")
    left = p.drop_near_duplicates(spark, docs, "")
    assert left.columns == docs.columns and sorted((r[0] or 0, r[1] or "", r[2]) for r in left.collect()) == sorted((r[0] or 0, r[1] or "", r[2]) for r in rows[:-1])
