"""Substring dedup by super-k-mers.

A window is ``k`` consecutive words. Its minimiser is the smallest hash among its ``M``-word sequences, so equal windows
have equal minimisers. Consecutive windows of a document that share their minimiser travel as one packed string of words
to the minimiser's bucket; there the windows are sorted and equal ones counted exactly.

* Before the shuffle, equal packed strings of a block are collapsed: the smallest doc_id of the block goes on, the
  others are already known to repeat it. A group of copies therefore sends one string per block, not per document.
* Repeated windows that follow one another in a text are one range, however they travelled: a passage that many
  documents have is a range per document, not one per window.
* In a bucket, strings whose minimiser occurs in one document only are put aside by their minimiser bits alone.
* A minimiser that is common in a sample (a template, a frequent word sequence) would make a hot bucket. Its windows
  travel one by one, dealt by the hash of the whole window. The sample only decides where windows go, never the result.
* Strings travel in packed rows, one per block and bucket, and each bucket is of bounded size because the number of
  buckets grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import bucket_count, plan_bytes, staged
from ledgerline.llm.text import WordBlock, bounded, give_back, gram_hashes, inside, mix64, pieces, word_block

M = 3
BUCKET_BYTES = 4 << 20
SAMPLE_BYTES = 16 << 20  # of the sample that looks for common minimisers
HOT_MOST = 512  # common minimisers at most


def pack_ints(values: np.ndarray) -> bytes:
    """Integers by byte planes, compressed."""
    if not len(values):
        return b""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def unpack_ints(packed: bytes, kind: type) -> np.ndarray:
    if not packed:
        return np.empty(0, kind)
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _minimisers(block: WordBlock, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window that lies in one text: its first word's position, its minimiser, and the hashes of all words."""
    hashes = block.hashes[block.codes]
    at = np.flatnonzero(inside(block.starts, k))
    if not len(at):
        return at, np.empty(0, np.uint64), hashes
    m = min(M, k)
    low, width, have = gram_hashes(hashes, m), k - m + 1, 1
    while have < width:  # sliding minimum by doubling
        step = min(have, width - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    return at, low[at], hashes


def _spaced(block: WordBlock) -> tuple[memoryview, np.ndarray]:
    """All words of the block, each followed by a space, and where each begins (one more offset than words)."""
    words = pc.binary_join_element_wise(block.words.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
    taken = words.take(pa.array(block.codes))
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False)[block.codes]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return memoryview(taken.buffers()[2] or b""), offsets


def _common(k: int):
    """Counts of the minimisers that hold a thousandth of a batch or more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            _, low, _ = _minimisers(word_block(batch.column("text")), k)
            values, counts = np.unique(low, return_counts=True)
            often = counts >= max(16, len(low) // 1000)
            yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], names=["low", "n"])

    return run


PACKED = "bucket int, docs binary, keys binary, places binary, lows binary, texts binary, known boolean"


def _super_kmers(k: int, buckets: int, hot: np.ndarray):
    """Packed rows: the super-k-mers of a block for each bucket, and rows of repeats that the block itself shows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            block = word_block(batch.column("text"))
            docs, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "key"))
            at, low, hashes = _minimisers(block, k)
            if not len(at):
                continue
            first = np.ones(len(at), bool)
            first[1:] = (np.diff(at) != 1) | (low[1:] != low[:-1])
            if len(hot):
                alone = np.isin(low, hot)
                first |= alone
                first[1:] |= alone[:-1]
                low = np.where(alone, gram_hashes(hashes, k)[at], low)
            begin = np.flatnonzero(first)
            windows = np.diff(np.append(begin, len(at)))
            begin, low = at[begin], mix64(low[begin])
            row = np.searchsorted(block.starts, begin, "right") - 1
            data, offsets = _spaced(block)
            a, b = offsets[begin].tolist(), (offsets[begin + windows + k - 1] - 1).tolist()
            strings = [bytes(data[x:y]) for x, y in zip(a, b, strict=True)]
            same = pa.array(strings, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
            smallest = np.full(int(same.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(smallest, same, docs[row])
            repeats = docs[row] > smallest[same]
            place = begin - block.starts[row]
            out: dict[str, list] = {c: [] for c in ("bucket", "docs", "keys", "places", "lows", "texts", "known")}

            def put(bucket: int, i: np.ndarray, lows: np.ndarray, text: bytes, known: bool) -> None:
                for c, v in zip(out, (bucket, pack_ints(docs[row[i]]), pack_ints(keys[row[i]]), pack_ints(place[i].astype(np.int32)), pack_ints(lows), text, known), strict=True):
                    out[c].append(v)

            known = np.flatnonzero(repeats)
            if len(known):
                whole, length = _merged(row[known], place[known], windows[known])
                known = known[whole]
                put(int(docs[row[known[0]]] % buckets), known, length.astype(np.uint32), b"", True)
            sent = np.flatnonzero(~repeats)
            bucket = (low[sent] >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            sent, bucket = sent[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            pack = zstandard.ZstdCompressor(level=3)
            for i, j in zip([0, *cuts], [*cuts, len(sent)], strict=True):
                if j > i:
                    part = sent[i:j]
                    put(int(bucket[i]), part, (low[part] & np.uint64(0xFFFFFF)).astype(np.uint32), pack.compress(b"\n".join([strings[x] for x in part])), False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["bucket"], pa.int32()), *(pa.array(out[c], pa.binary()) for c in ("docs", "keys", "places", "lows", "texts")), pa.array(out["known"], pa.bool_())],
                names=["bucket", "docs", "keys", "places", "lows", "texts", "known"],
            )

    return run


def _ranges(docs: np.ndarray, keys: np.ndarray, places: np.ndarray, windows: np.ndarray) -> pa.Table:
    return pa.table({"doc_id": pa.array(docs, pa.int64()), "key": pa.array(keys, pa.int64()), "start": pa.array(places.astype(np.int32)), "windows": pa.array(windows.astype(np.int32))})


def _merged(row: np.ndarray, place: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of windows, ordered by ``row`` and ``place``, with each that begins where its row's last one ends put to it.

    Returns which ranges begin a merged one, and how many windows each of those holds.
    """
    begins = np.ones(len(row), bool)
    begins[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + windows[:-1])
    first = np.flatnonzero(begins)
    return first, np.add.reduceat(windows, first)


def _joined(found: pa.Table) -> pa.Table:
    """The ranges of a bucket, with those of one text that touch put together and equal ones left once."""
    if not found.num_rows:
        return found
    docs, keys, places, windows = (found.column(c).to_numpy() for c in found.column_names)
    order = np.lexsort((windows, places, keys, docs))
    docs, keys, places, windows = (x[order] for x in (docs, keys, places, windows))
    once = np.ones(len(docs), bool)
    once[1:] = (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1]) | (places[1:] != places[:-1]) | (windows[1:] != windows[:-1])
    docs, keys, places, windows = (x[once] for x in (docs, keys, places, windows))
    text = np.cumsum(np.concatenate([[True], (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])]))
    first, length = _merged(text, places, windows)
    return _ranges(docs[first], keys[first], places[first], length)


def _repeats(k: int):
    """Windows of a bucket that also start in a document with a smaller id."""

    def run(table: pa.Table) -> pa.Table:
        known, docs, keys, places, lows, texts = [], [], [], [], [], []
        for row in table.to_batches():
            for i in range(row.num_rows):
                d, s, p, low = (unpack_ints(row.column(c)[i].as_py(), t) for c, t in (("docs", np.int64), ("keys", np.int64), ("places", np.int32), ("lows", np.uint32)))
                if row.column("known")[i].as_py():
                    known.append(_ranges(d, s, p, low))
                else:
                    docs.append(d), keys.append(s), places.append(p), lows.append(low), texts.append(row.column("texts")[i].as_py())
        found = [*known, _ranges(*(np.empty(0, np.int64) for _ in range(4)))]
        if docs:
            sizes = [len(x) for x in docs]
            docs, keys, places, lows = (np.concatenate(x) for x in (docs, keys, places, lows))
            # Only a minimiser that occurs in two documents can belong to a repeated window.
            order = np.lexsort((docs, lows))
            low, doc = lows[order], docs[order]
            group = np.concatenate([[0], np.cumsum(low[1:] != low[:-1])])
            begin = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
            end = np.append(begin[1:], len(low)) - 1
            shared = np.zeros(len(lows), bool)
            shared[order] = (doc[begin] != doc[end])[group]
            unpack, strings, at = zstandard.ZstdDecompressor(), [], 0
            for n, text in zip(sizes, texts, strict=True):
                want = np.flatnonzero(shared[at : at + n])
                if len(want):
                    own = unpack.decompress(text).split(b"\n")
                    strings += [own[x] for x in want]
                at += n
            if strings:
                found.append(_count(strings, docs[shared], keys[shared], places[shared], k))
                del strings
                give_back()
        return _joined(pa.concat_tables(found))

    return run


def _count(strings: list[bytes], docs: np.ndarray, keys: np.ndarray, places: np.ndarray, k: int) -> pa.Table:
    block = word_block(pa.array(strings, pa.large_binary()).cast(pa.large_string()))
    at = np.flatnonzero(inside(block.starts, k))
    grams = gram_hashes(block.hashes[block.codes], k)[at]
    row = np.searchsorted(block.starts, at, "right") - 1
    owner = docs[row]
    order = np.lexsort((owner, grams))
    equal = grams[order][1:] == grams[order][:-1]
    near = np.flatnonzero(equal)
    a, b = at[order[near]], at[order[near + 1]]
    if any((block.codes[a + i] != block.codes[b + i]).any() for i in range(k)):  # two windows of one hash: number the words' sequences
        _, grams = np.unique(np.stack([block.codes[at + i] for i in range(k)], axis=1), axis=0, return_inverse=True)
        order = np.lexsort((owner, grams))
        equal = grams[order][1:] == grams[order][:-1]
    begin = np.concatenate([[True], ~equal])
    smallest = owner[order][begin][np.cumsum(begin) - 1]
    repeated = np.zeros(len(at), bool)
    repeated[order] = owner[order] > smallest
    at, row = at[repeated], row[repeated]
    place = places[row] + (at - block.starts[row])
    if not len(at):
        return _ranges(*(np.empty(0, np.int64) for _ in range(4)))
    first = np.ones(len(at), bool)
    first[1:] = (np.diff(at) != 1) | (np.diff(row) != 0)
    begin = np.flatnonzero(first)
    return _ranges(docs[row[begin]], keys[row[begin]], place[begin], np.diff(np.append(begin, len(at))))


def _cut(k: int, column: str):
    """Kept words of each row, joined by one space."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(x, y - x) for b in batches for x, y in pieces(b.column("row").field(column))):
            texts = batch.column("row").field(column)
            n = batch.num_rows
            block = word_block(texts)
            gone = np.zeros(len(block.codes) + 1, np.int32)
            ranges = batch.column("ranges")
            flat = ranges.flatten()
            if len(flat):
                row = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(ranges), 0).to_numpy(zero_copy_only=False))
                start = flat.field("start").to_numpy(zero_copy_only=False) + block.starts[row]
                np.add.at(gone, start, 1)
                np.add.at(gone, start + flat.field("windows").to_numpy(zero_copy_only=False) + k - 1, -1)
            keep = np.cumsum(gone[:-1]) == 0
            counts = np.diff(block.starts)
            kept = WordBlock(np.concatenate([[0], np.cumsum(keep)])[block.starts].astype(np.int64), block.codes[keep], block.words, block.hashes)
            data, offsets = _spaced(kept)
            a, b = offsets[kept.starts[:-1]].tolist(), offsets[kept.starts[1:]].tolist()
            out = pa.array([bytes(data[x : max(x, y - 1)]) for x, y in zip(a, b, strict=True)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(counts.astype(np.int64)), pa.array((counts - np.diff(kept.starts)).astype(np.int64)), out], names=["row", "n_words", "n_removed", "kept"]
            )

    return run


def _key(text: Column) -> Column:
    """Tells rows that repeat a doc_id apart: 64 bits, so that any number of texts under one doc_id stay apart."""
    return F.xxhash64(text)


def remove_repeats(docs: DataFrame, k: int = 13, text: str = "text") -> DataFrame:
    """Words left after removing every word covered by a window that also starts in a document with a smaller doc_id.

    Windows are judged on the input. Returns ``row`` (the input row as a struct, extra columns included), ``n_words``,
    ``n_removed`` and ``kept`` (kept words joined by one space; empty if none). A null text has no words. A row whose
    doc_id is null is returned whole and makes no other row a repeat. Rows that repeat a doc_id are each judged by
    their own words; equal doc_ids never make each other a repeat.
    """
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(F.col(text)).alias("key"), F.col(text).alias("text")).filter("doc_id is not null and text is not null")
    fraction = min(1.0, SAMPLE_BYTES / max(plan_bytes(words), 1))
    buckets = bucket_count(docs, BUCKET_BYTES)
    common = words.select("text").sample(fraction, seed=7).mapInArrow(_common(k), "low long, n long").groupBy("low").agg(F.sum("n").alias("n"))
    hot = np.array([r.low for r in common.orderBy(F.desc("n"), "low").limit(HOT_MOST).collect()], np.int64).view(np.uint64)
    packed = words.mapInArrow(_super_kmers(k, buckets, hot), PACKED)
    found = staged(packed.groupBy("bucket").applyInArrow(_repeats(k), "doc_id long, key long, start int, windows int"), "substr-repeats")
    ranges = found.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "windows")).alias("ranges"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keyed = rows.withColumn("doc_id", F.col("row.doc_id").cast("long")).withColumn("key", _key(F.col(f"row.{text}")))
    joined = keyed.join(ranges, ["doc_id", "key"], "left").select("row", "ranges")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_cut(k, text), f"row {kind}, n_words long, n_removed long, kept string")
