"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item is one window); a document word inside any
occurrence of a window is hit. For a window to occur, the set of its word shingles must be contained in the document's:

1. One pass over the documents keeps the places where any shingle of any item starts (matching by 64-bit hash), and one
   more row per document with its number of words.
2. The places give every shingle's frequency in the corpus, so each window's shingles are ordered by rarity. Full
   containment needs a prefix of one token: the window's rarest shingle. A window with a shingle that occurs nowhere is
   out at once.
3. Places of the prefix shingle propose the window's start; the start and the window's length must fit in the document.
4. What is left is verified word by word on the document. Only texts with a proposed start are split and shuffled again.

No side is broadcast by a hint: the item tables are stage tables whose written size Spark knows, and it broadcasts them
only below ``spark.sql.autoBroadcastJoinThreshold``; beyond it the joins are shuffled.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import staged

WINDOW, SHINGLE = 13, 5
WORD = r"[a-z0-9\x{80}-\x{10FFFF}]+"  # of lower-cased text; Java's regex takes a tenth of the time of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
SPREAD = 1024  # join keys of the rows that hold a document's number of words


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else (``lower`` does just that to a text of one-byte characters)."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def _shingles(words: str, n: int) -> Column:
    """Hashes of the ``n``-word sequences of an array column, in order; empty if it has fewer words."""
    parts = ", ".join(f"{words}[i + {j}]" for j in range(n))
    return F.expr(f"CASE WHEN size({words}) >= {n} THEN transform(sequence(0, size({words}) - {n}), i -> xxhash64({parts})) ELSE array() END")


def item_windows(items: DataFrame) -> DataFrame:
    """``item_id`` (string) and ``win`` (words) of every window of every item that has words."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w")).filter("size(w) > 0")
    return words.select("item_id", F.explode(F.expr(f"transform(sequence(0, greatest(size(w) - {WINDOW}, 0)), i -> slice(w, i + 1, {WINDOW}))")).alias("win"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Benchmark words of each document; one row per row of ``docs`` (``doc_id``, ``text``; other columns ignored).

    Returns ``doc_id``, ``text_key`` (hash of the text, tells rows that repeat a doc_id apart), ``n_words``, ``n_hit``,
    ``items`` (sorted ids of items with occurring windows) and ``contaminated`` (n_hit > 0 and 20 * n_hit >= n_words).
    Null texts have no words; items without words have no windows. An item with a null id hits words but isn't listed;
    rows that repeat an item_id are one item.
    """
    pairs = staged(item_windows(items).distinct().withColumn("win_id", F.xxhash64("win")), "decontam-items")
    windows = pairs.select("win").distinct()
    pieces = windows.select("win", F.expr(f"least({SHINGLE}, size(win))").alias("n"))
    lengths = [r.n for r in pieces.select("n").distinct().orderBy("n").collect()]  # at most SHINGLE values
    parts = [pieces.filter(F.col("n") == n).select("win", "n", F.posexplode(_shingles("win", n)).alias("offset", "hash")) for n in lengths]
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    if not parts:
        return rows.select("doc_id", "text_key", F.size(words_of(F.col("text"))).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"), F.lit(False).alias("contaminated"))
    shingled = parts[0]
    for part in parts[1:]:
        shingled = shingled.union(part)
    shingled = staged(shingled, "decontam-shingles")
    wanted = staged(shingled.select("n", "hash").distinct(), "decontam-wanted")

    # 1. places where a shingle of an item starts; of every document one row at -1 (its key in the join is one of SPREAD)
    split = rows.select("doc_id", "text_key", words_of(F.col("text")).alias("w"))
    places = None
    for n in lengths:
        counted = places is None
        starting = f"sequence(-1, greatest(size(w) - {n}, -1))" if counted else f"CASE WHEN size(w) >= {n} THEN sequence(0, size(w) - {n}) ELSE array() END"
        at = split.select("doc_id", "text_key", "w", F.size("w").alias("n_words"), F.explode(F.expr(starting)).alias("pos"))
        words = ", ".join(f"get(w, pos + {j})" for j in range(n))
        at = at.select("doc_id", "text_key", "n_words", "pos", F.expr(f"IF(pos < 0, pmod(text_key, {SPREAD}), xxhash64({words}))").alias("hash"))
        own = wanted.filter(F.col("n") == n)
        if counted:
            own = own.union(docs.sparkSession.range(SPREAD).select(F.lit(n).alias("n"), "id")).distinct()
        some = at.join(own, "hash").select("doc_id", "text_key", "n_words", "pos", "n", "hash")
        places = some if places is None else places.union(some)
    places = staged(places, "decontam-places")
    counts = places.filter("pos < 0").select("doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"))
    places = places.filter("pos >= 0")

    # 2. the rarest shingle of each window
    often = places.groupBy("n", "hash").agg(F.count("*").alias("often"))
    order = F.struct(F.coalesce("often", F.lit(0)).alias("often"), "hash", "offset")
    prefix = shingled.join(often, ["n", "hash"], "left").groupBy("win", "n").agg(F.min(order).alias("rarest")).filter("rarest.often > 0")
    prefix = staged(prefix.select("win", "n", "rarest.hash", "rarest.offset"), "decontam-prefix")

    # 3. starts that fit
    starts = places.join(prefix, ["n", "hash"]).withColumn("start", F.col("pos") - F.col("offset"))
    starts = starts.filter(F.expr("start >= 0 AND start + size(win) <= n_words"))
    proposed = staged(starts.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "win")).alias("proposed")), "decontam-proposed")

    # 4. verify on the words
    def same(left: str, right: str) -> Column:
        return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.text_key") == F.col(f"{right}.text_key"))

    keys = staged(proposed.select("doc_id", "text_key"), "decontam-keys")  # a small table of its own, so that Spark may broadcast it
    mine = rows.alias("d").join(keys.alias("k"), same("d", "k"), "left_semi")
    joined = mine.join(proposed.alias("p"), same("d", "p")).select("d.doc_id", "d.text_key", words_of(F.col("d.text")).alias("w"), "p.proposed")
    found = joined.select("doc_id", "text_key", F.expr("filter(proposed, p -> slice(w, p.start + 1, size(p.win)) = p.win)").alias("found"))
    covered = F.expr("size(array_distinct(flatten(transform(found, f -> sequence(f.start, f.start + size(f.win) - 1)))))")
    judged = found.filter(F.size("found") > 0).select("doc_id", "text_key", covered.cast("long").alias("n_hit"), F.expr("array_distinct(transform(found, f -> f.win))").alias("wins"))
    judged = staged(judged.dropDuplicates(["doc_id", "text_key"]), "decontam-judged")
    named = judged.select("doc_id", "text_key", F.explode("wins").alias("win")).join(pairs, "win").filter("item_id is not null")
    listed = named.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    hits = judged.alias("j").join(listed.alias("l"), same("j", "l"), "left").select("j.doc_id", "j.text_key", "j.n_hit", "l.items")
    both = counts.alias("c").join(hits.alias("h"), same("c", "h"), "left")
    both = both.select(
        "c.doc_id", "c.text_key", "c.n_words",
        F.coalesce("h.n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("h.items", F.array().cast("array<string>")).alias("items"),
    )
    return both.withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
