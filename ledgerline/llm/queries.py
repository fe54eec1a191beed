"""The registered queries of the operators, and SQL for those that SQL can express.

Each query reads its whole table, applies the operator with production parameters and derives the digest columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import ann, audit, decontam, html, langid, lloyd, lm, mixing, near, quality, simhash, substr, warc
from ledgerline.llm.shared import tables


def _remainder(modulus: int) -> str:
    return f"crc32(cast(doc_id as string)) % {modulus}"


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under a backoff model of the rows that are not held out."""
    return lm.score(tables(spark, sf_dir, "documents"), f"{_remainder(7)} = 2")


def op3_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest other vectors of every vector whose id is divisible by 50."""
    return ann.search(tables(spark, sf_dir, "embeddings"), every=50, k=5)


def op4_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to deduplicated WARC archives and read back."""
    return warc.roundtrip(tables(spark, sf_dir, "pages"))


def op5_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn by flattened source weights for a budget of all tokens, no source more than twice."""
    drawn = mixing.mix(tables(spark, sf_dir, "documents").select("doc_id", "text", "source"), repetitions=2.0)
    return drawn.select("row.doc_id", "row.source", "n_tokens", "epoch", "block", F.round("weight", 9).alias("weight"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = tables(spark, sf_dir, "pages")
    found = html.extract(pages.select("page_id", "url", "html"), html.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labelled rows that are not held out."""
    docs, labels = tables(spark, sf_dir, "documents").select("doc_id", "text"), tables(spark, sf_dir, "labels")
    held = F.expr(f"{_remainder(5)} = 0")
    scored = quality.score(docs, quality.train(docs, labels.filter(~held)))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.expr(f"{_remainder(5)} = 0")
    found = langid.identify(docs.drop("lang"), langid.train(docs.filter(~held)))
    return found.select("doc_id", held.alias("held_out"), "language.lang_pred", "language.score")


def op2_super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 13-word passages that a document with a smaller id has."""
    left = substr.remove_repeats(tables(spark, sf_dir, "documents").select("doc_id", "text"), k=13)
    return left.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words of every document."""
    return decontam.digest(decontam.contamination(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "benchmark")))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return near.near_duplicates(tables(spark, sf_dir, "documents"), shingle=3, percent=85)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding after three rounds from 16 hashed starting vectors."""
    return lloyd.digest(lloyd.cluster(tables(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return simhash.digest(simhash.edited_fingerprints(tables(spark, sf_dir, "documents")))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from every source, under all orders of the filters."""
    return audit.audit(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_katz_backoff": op1_katz_backoff,
    "op2_super_kmer_dedup": op2_super_kmer_dedup,
    "op3_ann_search": op3_ann_search,
    "op4_warc_revisit": op4_warc_revisit,
    "op5_temperature_mixing": op5_temperature_mixing,
    "op6_main_text": op6_main_text,
    "op7_decontamination": op7_decontamination,
    "op8_quality": op8_quality,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_language": op10_language,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_simhash": op12_simhash,
    "op13_filter_audit": op13_filter_audit,
}

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"'[^\x20\x09-\x0D]+'"

ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_GAP = "list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _lloyd_sql(k: int, rounds: int, dims: int, scale: int) -> str:
    """Lloyd's rounds written out one after another: ``near<r>`` assigns, ``mean<r>`` and ``c<r>`` move the centroids."""
    parts = [
        f"""v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = {dims} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))""",
        f"""c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS k, e
  FROM (SELECT sha256('1:' || vec_id) AS h, e FROM v ORDER BY h LIMIT {k}))""",
    ]
    for r in range(rounds + 1):
        parts.append(f"""near{r} AS (
  SELECT vec_id, e, best.d AS d, best.k AS k
  FROM (SELECT v.vec_id, v.e, min({{'d': CAST({_GAP} AS BIGINT), 'k': c.k}}) AS best FROM v, c{r} AS c GROUP BY v.vec_id, v.e))""")
        if r < rounds:
            parts.append(f"""mean{r} AS (
  SELECT k, list(m ORDER BY i) AS e
  FROM (SELECT k, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM (SELECT k, unnest(e) AS x, unnest(range(1, {dims} + 1)) AS i FROM near{r}) GROUP BY k, i) GROUP BY k),
c{r + 1} AS (SELECT c.k, coalesce(m.e, c.e) AS e FROM c{r} AS c LEFT JOIN mean{r} AS m USING (k))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, k AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM near{rounds} JOIN c{rounds} AS c USING (k)"""


def _simhash_sql(n: int, bits: int, radius: int) -> str:
    """Votes bit by bit over the terms of the text (``z`` = 0) and of the edited text (``z`` = 1)."""
    votes = ",\n    ".join(f"CASE WHEN 2 * sum((h >> {i}) & 1) > count(h) THEN 1 ELSE 0 END AS b{i}" for i in range(bits))
    digits = [f"8 * b{i + 3} + 4 * b{i + 2} + 2 * b{i + 1} + b{i}" for i in range(bits - 4, -1, -4)]
    fingerprint = " || ".join(f"substr('0123456789abcdef', {d} + 1, 1)" for d in digits)
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(n))
    return f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
chain AS (
  SELECT doc_id, text, length(text) AS n, coalesce(lead(text) OVER o, first_value(text) OVER o) AS after,
    coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id
  FROM doc WINDOW o AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edit AS (SELECT *, left(text, n - n // 2) || left(after, n // 2) AS edited FROM chain),
split AS (
  SELECT doc_id, z, regexp_extract_all({LOWER}, {WORDS}) AS w
  FROM (SELECT doc_id, 0 AS z, text FROM edit UNION ALL SELECT doc_id, 1, edited FROM edit)),
term AS (
  SELECT doc_id, z, unnest(CASE WHEN len(w) = 0 THEN [NULL] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
    ELSE [{gram} for i in range(1, len(w) - {n - 2})] END) AS g FROM split),
hashed AS (SELECT doc_id, z, ('0x' || left(md5(g), {bits // 4}))::UBIGINT AS h FROM term),
voted AS (
  SELECT doc_id, z,
    {votes}
  FROM hashed GROUP BY doc_id, z),
print AS (SELECT doc_id, z, {fingerprint} AS f FROM voted),
code AS (SELECT doc_id, z, f, ('0x' || f)::UBIGINT AS v FROM print),
one AS (SELECT DISTINCT v FROM code WHERE z = 0),
crowd AS (SELECT x.v, count(*) AS m FROM one x JOIN one y ON x.v <> y.v AND bit_count(xor(x.v, y.v)::BIT) <= {radius} GROUP BY x.v)
SELECT e.doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, a.f AS fingerprint, b.f AS edited_fingerprint,
  CAST(1 - bit_count(xor(a.v, b.v)::BIT) / {bits}.0 AS DOUBLE) AS near_edited,
  CAST(1 - bit_count(xor(a.v, c.v)::BIT) / {bits}.0 AS DOUBLE) AS near_next, coalesce(m, 0) AS n_near
FROM edit e JOIN code a ON a.doc_id = e.doc_id AND a.z = 0 JOIN code b ON b.doc_id = e.doc_id AND b.z = 1
JOIN code c ON c.doc_id = e.next_id AND c.z = 0 LEFT JOIN crowd ON crowd.v = a.v"""


ORACLE_SQL: dict[str, str] = {
    "op12_simhash": _simhash_sql(n=5, bits=64, radius=3),
    "op11_centroid_clustering": _lloyd_sql(k=16, rounds=3, dims=64, scale=64),
    "op13_filter_audit": f"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w
  FROM documents),
mark AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS bad FROM labels GROUP BY doc_id),
judged AS (
  SELECT doc_id, part, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
    + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(doc_id > min(doc_id) OVER (PARTITION BY t) AS INT) AS mask
  FROM doc),
cell AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad
  FROM judged LEFT JOIN mark USING (doc_id) GROUP BY part, mask),
f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, s AS step, bits[s] AS bit, coalesce(list_sum(bits[1:s - 1]), 0)::INT AS past FROM orders, range(1, 6) AS r(s)),
counted AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (past | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & past = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & past <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & past = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & past = 0 AND mask & bit <> 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM cell, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted""",
    "op4_warc_revisit": """
WITH record AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digest AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS d FROM record),
last AS (SELECT d, max(page_id) AS m FROM digest WHERE n >= 1000 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN m > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN m > page_id THEN m END AS refers_to
FROM digest LEFT JOIN last USING (d)""",
    "op2_super_kmer_dedup": f"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM split)),
earliest AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN earliest USING (g), range(13) AS r(j) WHERE m < doc_id),
word AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM split),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(t, ' ' ORDER BY p) AS s
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(s, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)""",
    "op7_decontamination": f"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), {ALNUM}) AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(coalesce({LOWER}, ''), {ALNUM}) AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size)),
found AS (SELECT doc_id, item_id, i, n FROM place JOIN win USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM found, range(13) AS r(j) WHERE j < n GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)""",
    "op9_minhash_near_dedup": f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), {WORDS}) AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS s FROM split),
member AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM member a JOIN member b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT x, y FROM pairs UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
  least(doc_id, coalesce((SELECT min(y) FROM reach WHERE reach.x = sets.doc_id), doc_id)) AS component_id,
  doc_id <= coalesce((SELECT min(y) FROM reach WHERE reach.x = sets.doc_id), doc_id) AS kept
FROM sets""",
}
