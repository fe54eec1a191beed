"""WARC archives with revisit records.

Headers (page, digest, length) are shuffled by payload digest to find the response of each payload; every other record
becomes a revisit of it. The decision goes back to the pages by page_id, which is unique, so a payload that a third of
all pages share makes no hot join key for the texts. Archives are written by Spark's text writer: a record is the value
of a row and the blank lines between records are the line separator, so a file is a plain sequence of WARC/1.1 records.
Files are compressed whole, hence never split: a reader sees each file's records in order and cuts them by
Content-Length. On reading, revisits are joined to their responses by record id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shared import staged
from ledgerline.session import scratch_path

LEAST_BYTES = 1000  # shorter payloads are never revisited
RECORDS_PER_FILE = 50_000
DATE = "1970-01-01T00:00:00Z"
BLANK = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.lit("page"), page, digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat_ws("\r\n", *[F.concat(F.lit(f"{name}: "), value) for name, value in pairs])


def plan_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``page_id``, ``digest`` and ``refers_to`` (page_id of the response) of every record that revisits another.

    Of the records with one payload of ``least_bytes`` or more, that with the largest page_id is the response. A record
    with a null page_id is always a response, as are all rows that repeat the largest page_id.
    """
    headers = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    headers = headers.filter(F.col("page_id").isNotNull() & (F.octet_length("html") >= least_bytes)).select("page_id", F.sha1("html").alias("digest"))
    headers = staged(headers, "warc-headers")
    first = headers.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).filter("least < refers_to")
    return headers.join(first.select("digest", "refers_to"), "digest").filter("page_id < refers_to").distinct()


def records(pages: DataFrame, revisits: DataFrame) -> DataFrame:
    """``value``: one WARC record per row of ``pages`` (``page_id``, ``url``, ``html``), without the blank lines after it."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace("url", r"[\x00-\x20\x7F]", "").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    own = own.withColumn("digest", F.sha1("html"))
    both = own.join(revisits, ["page_id", "digest"], "left")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), _lines(("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.octet_length("html").cast("string"))), F.lit(BLANK))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    page = F.col("page_id").cast("string")
    head = _lines(
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", _record_id(page, F.col("digest"))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Page-ID", page),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to").cast("string"), F.col("digest")))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", F.octet_length("block").cast("string")),
    )
    return both.withColumn("block", block).select(F.concat(F.lit("WARC/1.1\r\n"), head, F.lit(BLANK), F.col("block")).alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write the deduplicated archives of ``pages`` under ``path`` (a folder that does not exist yet)."""
    out = records(pages, plan_revisits(pages, least_bytes))
    out.write.option("lineSep", BLANK).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a stream of pieces, each of which the separator followed."""
    gap = BLANK.encode()
    held = bytearray()
    head: dict[str, str] | None = None
    for piece in pieces:
        held += piece
        held += gap
        while True:
            if head is None:
                while held.startswith(gap):
                    del held[: len(gap)]
                end = held.find(gap)
                if end < 0:
                    break
                lines = held[:end].decode("utf-8").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
                head = dict(x.split(": ", 1) for x in lines[1:])
                del held[: end + len(gap)]
            need = int(head["Content-Length"])
            if len(held) < need + len(gap):
                break
            yield head, bytes(held[:need])
            del held[: need + len(gap)]
            head = None
    if head is not None or held.strip():
        raise ValueError("an archive ends inside a record")


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "record_type", "record_id", "refers", "payload_digest", "payload_bytes", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
    rows: list[tuple] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal held
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        rows.clear()
        held = 0
        return out

    pieces = (x.as_buffer().to_pybytes() for b in batches for x in b.column(0).cast(pa.binary()))
    for head, block in parse_records(pieces):
        http, _, payload = block.partition(BLANK.encode())
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        size, full = len(payload), head["WARC-Type"] == "response"
        if full and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
        page = head.get("WARC-Page-ID")
        rows.append((int(page) if page is not None else None, head.get("WARC-Target-URI"), head["WARC-Type"], head["WARC-Record-ID"], head.get("WARC-Refers-To"), digest, size if full else None, payload.decode() if full else None))
        held += size
        if len(rows) >= 2000 or held > 16 << 20:
            yield flush()
    if rows:
        yield flush()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under ``path``: a response with its payload, a revisit with the id of its response."""
    pieces = spark.read.option("lineSep", BLANK).text(path)
    return pieces.mapInArrow(_read, "page_id long, url string, record_type string, record_id string, refers string, payload_digest string, payload_bytes long, payload string")


def resolve(found: DataFrame) -> DataFrame:
    """Revisits joined to their responses: adds ``refers_to`` (page_id) and the full payload's length to each revisit."""
    slim = staged(found.drop("payload", "url"), "warc-records")
    responses = slim.filter("record_type = 'response'").groupBy("record_id").agg(F.min("page_id").alias("refers_to"), F.min("payload_bytes").alias("full_bytes"))
    both = slim.filter("record_type = 'revisit'").join(responses.withColumnRenamed("record_id", "refers"), "refers", "left")
    columns = ["page_id", "payload_digest", "record_type"]
    revisits = both.select(*columns, F.col("full_bytes").alias("payload_bytes"), "refers_to")
    return slim.filter("record_type = 'response'").select(*columns, "payload_bytes", F.lit(None).cast("long").alias("refers_to")).union(revisits)


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write the archives of ``pages`` to the shared scratch folder and read them back, resolved; a row per page.

    A null html has the empty payload; a null url leaves its header out; a null page_id leaves its header out and is a
    response. Columns other than ``page_id``, ``url`` and ``html`` are ignored.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return resolve(read_archives(spark, path))
