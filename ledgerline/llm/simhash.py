"""SimHash fingerprints and their search within a Hamming radius, in DataFrame functions only.

A text's terms are its ``SHINGLE``-word shingles (A-Z lower-cased; a shorter text is one term), weighted by how often they
occur. The first ``BITS`` bits of a term's MD5 vote: each occurrence votes on every bit, and a fingerprint bit is set where
more than half of the weight says 1. Four bits are counted in one long (lanes of 16 bits), so a bit costs a quarter of a
sum; texts are voted in pieces of ``PIECE`` terms, so no lane overflows however long the text is.

``within`` finds all pairs of fingerprints at most ``radius`` bits apart through permuted block tables: the fingerprint is
cut into ``blocks`` blocks, a close pair differs in at most ``radius`` of them, so it agrees on the ``blocks - radius``
leading blocks of at least one permutation.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.decontam import lower_ascii
from ledgerline.llm.shared import staged

SHINGLE, BITS, PIECE, RADIUS = 5, 64, 1 << 14, 3
ONE_OF_16 = 0x0001000100010001
LOW_16_OF_32 = 0x0000FFFF0000FFFF
NO_ID = -(1 << 63)  # stands for a null doc_id in join keys


def _terms(words: str) -> Column:
    """MD5 (hex) of every shingle of an array column, repeats included."""
    gram = ", ".join(f"{words}[i + {j}]" for j in range(SHINGLE))
    return F.expr(
        f"CASE WHEN size({words}) >= {SHINGLE} THEN transform(sequence(0, size({words}) - {SHINGLE}), i -> md5(concat_ws(' ', {gram}))) "
        f"WHEN size({words}) > 0 THEN array(md5(array_join({words}, ' '))) END"
    )


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``bits`` (the fingerprint as a long) of every row.

    Rows must be told apart by ``keys``; if the input is partitioned by some of them, nothing is shuffled here. A null text
    or one without words has the fingerprint 0. A tied bit is 0.
    """
    words = texts.select(*keys, F.array_remove(F.split(lower_ascii(F.coalesce(F.col(text), F.lit(""))), r"\s+"), "").alias("w"))
    each = words.select(*keys, F.posexplode_outer(_terms("w")).alias("pos", "term"))
    hashed = F.expr(f"cast(conv(substr(term, 1, {BITS // 4}), 16, -10) as bigint)")
    voted = each.select(*keys, F.expr(f"coalesce(pos, 0) div {PIECE}").alias("piece"), hashed.alias("vote"))
    lanes = [F.sum(F.shiftrightunsigned("vote", i).bitwiseAND(F.lit(ONE_OF_16))).alias(f"s{i}") for i in range(16)]
    pieces = voted.groupBy(*keys, "piece").agg(F.count("vote").alias("terms"), *lanes)
    wide = []  # 16-bit lanes 0 and 2, then 1 and 3, as lanes of 32 bits
    for i in range(16):
        wide.append(F.sum(F.col(f"s{i}").bitwiseAND(F.lit(LOW_16_OF_32))).alias(f"s{i}e"))
        wide.append(F.sum(F.shiftrightunsigned(f"s{i}", 16).bitwiseAND(F.lit(LOW_16_OF_32))).alias(f"s{i}o"))
    return pieces.groupBy(*keys).agg(F.sum("terms").alias("terms"), *wide).select(*keys, _majority().alias("bits"))


def _majority() -> Column:
    """Sets the bits whose count is more than half of ``terms``. Bit 16 * lane + i was counted in lane ``lane`` of sum i."""
    bits = F.lit(0).cast("long")
    for i in range(16):
        for lane in range(4):
            count = F.expr(f"shiftrightunsigned(s{i}{'o' if lane % 2 else 'e'}, {32 * (lane // 2)}) & {0xFFFFFFFF}L")
            bit = 1 << (16 * lane + i)
            bits = bits.bitwiseOR(F.when(2 * count > F.col("terms"), F.lit(bit - (1 << 64) if bit >> 63 else bit)).otherwise(F.lit(0).cast("long")))
    return bits


def as_hex(bits: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(bits)), BITS // 4, "0"))


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def within(prints: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """All pairs of different fingerprints at most ``radius`` bits apart: ``a``, ``b`` (longs, a < b) and ``distance``.

    ``prints`` has ``bits``; equal fingerprints are one (documents are members of their fingerprint's class, so copies are
    never paired). There is a table for each choice of ``blocks - radius`` blocks (``radius + 3`` blocks by default: 20
    tables led by about 32 bits at radius 3), keyed by those blocks; more blocks give longer keys and more tables. A pair
    is taken from the table of the first blocks that it shares, so it comes out once. Nulls take no part. An empty table
    has no pairs.
    """
    digits = BITS // 4
    blocks = blocks or min(radius + 3, digits)
    if not 0 < radius < blocks <= digits:
        raise ValueError(f"need 0 < radius < blocks <= {digits}")
    cuts = [round(i * digits / blocks) for i in range(blocks + 1)]
    each = prints.filter("bits is not null").select("bits").distinct().withColumn("fp", as_hex("bits"))
    cut = each.select("bits", F.array(*[F.substring("fp", a + 1, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]).alias("part"))
    tables = [F.struct(F.lit(",".join(map(str, c))).alias("lead"), F.concat(*[F.col("part")[i] for i in c]).alias("key")) for c in combinations(range(blocks), blocks - radius)]
    rows = cut.select("bits", "part", F.inline(F.array(*tables)))
    a, b = rows.alias("a"), rows.hint("merge").alias("b")
    met = a.join(b, (F.col("a.lead") == F.col("b.lead")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.bits") < F.col("b.bits")))
    apart = distance("a.bits", "b.bits")
    shared = f"slice(filter(sequence(0, {blocks - 1}), i -> a.part[i] = b.part[i]), 1, {blocks - radius})"
    close = met.filter((apart <= radius) & (F.expr(f"array_join({shared}, ',')") == F.col("a.lead")))
    return close.select(F.col("a.bits").alias("a"), F.col("b.bits").alias("b"), apart.cast("int").alias("distance"))


def neighbours(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``bits`` and ``n_near``, the number of other fingerprints within the radius, of the fingerprints that have some."""
    pairs = within(prints, radius)
    return pairs.select(F.explode(F.array("a", "b")).alias("bits")).groupBy("bits").agg(F.count("*").alias("n_near"))


def _following(ids: DataFrame) -> DataFrame:
    """``ids`` (k, h, ...) with the key of the next row by k descending, then h; the first row follows the last.

    Rows are sorted within ranges of k and h. Only the ends of the ranges meet in one task: a row per range.
    """
    ranges = ids.repartitionByRange(F.desc("k"), F.asc("h")).withColumn("range", F.spark_partition_id())
    placed = staged(ranges, "simhash-order")
    inside = Window.partitionBy("range").orderBy(F.desc("k"), "h")
    key = F.struct("k", "h")
    led = placed.select("*", F.lead(key).over(inside).alias("next"), F.lag(key).over(inside).isNull().alias("leads"))
    heads = staged(led.filter("leads").select("range", key.alias("head")), "simhash-heads")
    ring = Window.orderBy("range")  # a row per range
    after = heads.select("range", F.lead("head").over(ring).alias("after"))
    first = heads.orderBy("range").limit(1).select(F.col("head").alias("first"))
    ends = after.crossJoin(first).select("range", F.coalesce("after", "first").alias("after"))
    return led.join(F.broadcast(ends), "range").select(*ids.columns, F.coalesce("next", "after").alias("next"))


def edited_fingerprints(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Fingerprints of every document, of its edited text and of the next document.

    The edited text replaces the last floor(n_chars / 2) code points by the first as many (or all) of the next document, by
    descending doc_id; the first follows the last. ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Null texts
    are empty. A row without a doc_id comes after all others. Rows with the same doc_id and text are one document (each
    row is returned); rows with one doc_id and different texts follow each other by a hash of their text. A single document
    is its own next. An empty table gives no rows.

    Returns ``doc_id``, ``n_chars``, ``edited_sha256``, the fingerprints ``own``, ``edited`` and ``next`` as longs, and
    ``n_near``: how many other fingerprints of documents are within ``radius`` bits of ``own``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("k", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("h", F.xxhash64("text", F.col("doc_id").isNull()))
    ids = rows.groupBy("k", "h", "doc_id", F.length("text").cast("long").alias("n_chars")).agg(F.count("*").alias("copies"))
    chain = staged(_following(ids), "simhash-chain")
    # whoever a document follows asks for the first half of its own length
    asked = chain.select(F.col("next.k").alias("k"), F.col("next.h").alias("h"), F.col("k").alias("for_k"), F.col("h").alias("for_h"), F.expr("n_chars div 2").alias("wanted"))
    whole = rows.groupBy("k", "h").agg(F.first("text").alias("text"))  # copies of a row meet before the shuffle
    tails = whole.join(asked.hint("merge"), ["k", "h"]).select(F.col("for_k").alias("k"), F.col("for_h").alias("h"), F.expr("left(text, cast(wanted as int))").alias("tail"))
    both = whole.join(tails.hint("merge"), ["k", "h"])
    kept = F.expr("left(text, length(text) - length(text) div 2)")
    texts = both.select("k", "h", F.explode(F.array(F.struct(F.lit(0).alias("which"), "text"), F.struct(F.lit(1).alias("which"), F.concat(kept, "tail").alias("text")))).alias("t"))
    voters = texts.select("k", "h", "t.which", "t.text", F.when(F.col("t.which") == 1, F.sha2("t.text", 256)).alias("sha"))
    prints = staged(fingerprints(voters, ["k", "h", "which", "sha"]), "simhash-prints")
    own = prints.filter("which = 0").select("k", "h", F.col("bits").alias("own"))
    edited = prints.filter("which = 1").select("k", "h", F.col("bits").alias("edited"), F.col("sha").alias("edited_sha256"))
    behind = own.select(F.struct("k", "h").alias("next"), F.col("own").alias("after"))
    found = chain.join(own.hint("merge"), ["k", "h"]).join(edited.hint("merge"), ["k", "h"]).join(behind.hint("merge"), "next")
    crowd = neighbours(own.select(F.col("own").alias("bits")), radius).withColumnRenamed("bits", "own")
    found = found.join(crowd, "own", "left")
    some = found.withColumn("some", F.explode(F.expr(f"transform(sequence(0, (copies - 1) div {PIECE}), i -> least({PIECE}, copies - i * {PIECE}))")))
    each = some.withColumn("one", F.explode(F.expr("sequence(1, some)")))  # a row for every copy
    return each.select("doc_id", "n_chars", "edited_sha256", "own", "edited", F.col("after").alias("next"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_chars", "edited_sha256", as_hex("own").alias("fingerprint"), as_hex("edited").alias("edited_fingerprint"),
        (1 - distance("own", "edited") / BITS).alias("near_edited"), (1 - distance("own", "next") / BITS).alias("near_next"), "n_near",
    )
