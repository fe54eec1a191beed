import hashlib

from ledgerline.llm import warc
from ledgerline.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, refers_to long"


def pages():
    long, other = "<p>" + "x" * 1200, "é" * 500
    odd = "a" * 1100 + "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" + "\r\n\r\n"
    texts = [long, long, other, "short", "short", None, "", other, odd, odd + "\r\n", "\r\n" * 700, long, "\x00\x01" * 600]
    rows = [(i * 2, f"http://h/{i}\r\nX: y" if i % 4 else None, t, "d", 1) for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[11], (None, "u", long, None, None), (None, None, None, None, None)]


def brute(rows):
    out, last = [], {}
    for page, _, text, *_ in rows:
        b = (text or "").encode()
        if len(b) >= 1000 and page is not None:
            last[b] = max(last.get(b, page), page)
    for page, _, text, *_ in rows:
        b = (text or "").encode()
        to = last.get(b) if page is not None and last.get(b, page) > page else None
        out.append((page, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_roundtrip_matches_brute_force(spark):
    got = warc.roundtrip(spark.createDataFrame(pages(), SCHEMA).repartition(4)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(pages())


def test_payloads_survive(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(pages(), SCHEMA), path)
    found = warc.read_archives(spark, path).collect()
    assert len(found) == len(pages())
    texts = {(r.page_id, r.payload) for r in found if r.record_type == "response"}
    assert texts <= {(p, t or "") for p, _, t, *_ in pages()}
    assert all(r.payload is None and r.refers for r in found if r.record_type == "revisit")


def test_empty_table(spark):
    assert warc.roundtrip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_cut_archive_is_an_error():
    import pytest

    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3"
    assert [b for _, b in warc.parse_records([good, b"abc"])] == [b"abc"]
    with pytest.raises(ValueError):
        list(warc.parse_records([good]))
