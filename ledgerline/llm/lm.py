"""Katz backoff language model over words.

Good-Turing discounted bigram and unigram counts with backoff weights that make every history's probabilities sum to
one: p(w | h) = d(c(hw)) c(hw) / c(h) if hw was seen in training, else a(h) p(w), and p(w) = d(c(w)) c(w) / N if w was
seen, else the mass that discounting left, given to one class of unknown words.

Nothing that grows with the corpus is broadcast or gathered. Texts become packed blocks of word codes, written once.

1. Each block asks for its distinct words and bigrams, once each and with its own training counts (so a frequent n-gram
   is one entry per block), from the bucket of the n-gram's hash. A bucket adds up the counts, keeps its part of the
   n-gram table (``part=model`` below the stage folder, by order and bucket), and answers each block by position.
2. The discounts need only the numbers of n-grams seen once, twice, ...: one row per order.
3. With its answers a block scores every token but for the backoff weights. For each history it adds up whole numbers
   (how many followers it is the first to list, by count class) and sends them with its requests to the history's
   bucket, where the sums give the exact weight (kept as ``part=model`` of the weights table), and each request becomes
   an addend of its document's score.

``fit`` returns the stored model: counts, backoff weights and the statistics of the discounts, in tables by order and
bucket. ``Stored.score`` evaluates another corpus from those tables alone: each block asks for the counts of its n-grams
and the weights of its histories, and a token takes the highest order that was seen, else the weight times the order below.

N-grams are known by 48 bits of a 64-bit hash within a bucket chosen by the other bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shared import bucket_count, plan_bytes, staged
from ledgerline.llm.substr import pack_ints, unpack_ints
from ledgerline.llm.text import bounded, hash_words, mix64, word_block

K = 5  # counts up to K are discounted
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 10 << 20
BEGIN, END = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)
LOW = np.uint64((1 << 48) - 1)


def _pack_words(words: list[str]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress("\n".join(words).encode())


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block; codes are numbered by frequency so that most are small."""
    task = TaskContext.get().partitionId()
    for n, batch in enumerate(bounded(batches, "text", BLOCK_BYTES)):
        block = word_block(batch.column("text"), lower=True)
        order = np.argsort(-np.bincount(block.codes, minlength=len(block.words)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        words = block.words.take(pa.array(order)).to_pylist()
        ids, held = batch.column("doc_id"), batch.column("held_out")
        one = np.array([0, batch.num_rows], np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([(task << 32) + n]),
                pa.ListArray.from_arrays(pa.array(one), pa.array(ids.to_pylist(), pa.int64())),
                pa.ListArray.from_arrays(pa.array(one), pa.array(held.to_pylist(), pa.bool_())),
                pa.array([pack_ints(block.starts)], pa.binary()),
                pa.array([pack_ints(rank[block.codes])], pa.binary()),
                pa.array([_pack_words(words)], pa.binary()),
            ],
            names=["block", "doc_id", "held_out", "starts", "codes", "words"],
        )


class Block:
    """Tokens of a block's texts (begin mark, words, end) and its distinct unigrams and bigrams in bucket order."""

    def __init__(self, row: dict, buckets: int) -> None:
        starts, codes = unpack_ints(row["starts"], np.int64), unpack_ints(row["codes"], np.int32)
        text = zstandard.ZstdDecompressor().decompress(row["words"]).decode()
        hashes = hash_words(pa.array(text.split("\n") if text else [], pa.string()))
        lengths = np.diff(starts)
        n = len(lengths)
        self.doc_id, self.held = row["doc_id"], row["held_out"]
        self.texts, self.tokens = n, lengths + 1
        self.row = np.repeat(np.arange(n), lengths + 2)
        first = starts[:-1] + 2 * np.arange(n)
        s = np.empty(len(codes) + 2 * n, np.uint64)
        s[np.arange(len(codes)) + 2 * np.repeat(np.arange(n), lengths) + 1] = hashes[codes]
        s[first], s[first + lengths + 1] = BEGIN, END
        self.real = np.ones(len(s), bool)  # positions of tokens
        self.real[first] = False
        train = np.array([h is False for h in self.held], bool)[self.row]
        one = mix64(s)
        two = mix64(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + s[1:])[self.real[1:]]
        self.keys, self.at, self.counts, self.first = {}, {}, {}, {}
        for order, grams, own in ((1, one, train), (2, two, train[1:][self.real[1:]])):
            self.keys[order], self.first[order], self.at[order] = np.unique(_keys(grams, buckets), return_index=True, return_inverse=True)
            self.counts[order] = np.bincount(self.at[order], own, len(self.keys[order])).astype(np.int64)


def _keys(grams: np.ndarray, buckets: int) -> np.ndarray:
    return (((grams >> np.uint64(48)) % np.uint64(buckets)) << np.uint64(48)) | (grams & LOW)


def _begin_key(buckets: int) -> int:
    return int(_keys(mix64(np.array([BEGIN])), buckets)[0])


def _cuts(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Bucket and its part of the sorted keys."""
    bucket = (keys >> np.uint64(48)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
        if b > a:
            yield int(bucket[a]), slice(a, b)


def _pack_keys(keys: np.ndarray) -> bytes:
    low = keys & LOW
    return pack_ints(np.diff(low, prepend=np.uint64(0)))


def _unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(packed, np.uint64), dtype=np.uint64)


def _requests(buckets: int):
    names = ["bucket", "gram", "block", "keys", "counts"]
    schema = pa.schema([("bucket", pa.int32()), ("gram", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block, out = Block(row, buckets), []
                for order in (1, 2):
                    for bucket, part in _cuts(block.keys[order]):
                        out.append((bucket, order, row["block"], _pack_keys(block.keys[order][part]), pack_ints(block.counts[order][part].astype(np.uint32))))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for c, n in zip(zip(*out, strict=True), names, strict=True)], schema=schema)

    return run


COUNTED = "part string, gram int, bucket int, block long, types long, tokens long, often array<long>, keys binary, counts binary, mine binary"


def _count(buckets: int):
    begin = _begin_key(buckets)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        bucket, gram = table.column("bucket")[0].as_py(), table.column("gram")[0].as_py()
        blocks = table.column("block").to_pylist()
        keys = [_unpack_keys(x.as_py()) for x in table.column("keys")]
        own = np.concatenate([unpack_ints(x.as_py(), np.uint32) for x in table.column("counts")]).astype(np.int64)
        sizes = [len(x) for x in keys]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, own, len(distinct)).astype(np.int64)
        first = np.full(len(distinct), len(at))
        seen = np.flatnonzero(own)
        np.minimum.at(first, at[seen], seen)
        mine = np.zeros(len(at), np.uint8)
        mine[first[first < len(at)]] = 1
        real = total > 0
        tokens = real.copy()
        if gram == 1 and begin >> 48 == bucket:
            tokens &= distinct != np.uint64(begin & ((1 << 48) - 1))
        often = [int((total[tokens] == r).sum()) for r in range(1, K + 2)]
        rows = [("model", gram, bucket, None, int(tokens.sum()), int(total[tokens].sum()), often, _pack_keys(distinct[real]), pack_ints(total[real].astype(np.uint64)), None)]
        end = 0
        for block, size in zip(blocks, sizes, strict=True):
            a, end = end, end + size
            rows.append(("reply", gram, bucket, block, None, None, None, None, pack_ints(total[at[a:end]].astype(np.uint64)), np.packbits(mine[a:end]).tobytes()))
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in COUNTED.split(", ")])

    return run


def discounts(often: list[int]) -> np.ndarray:
    """Factor of a count r (index r; the last entry is for all larger counts), from the numbers of n-grams seen 1 to K + 1 times.

    Katz's Good-Turing factors; where the numbers give none between 0 and 1, absolute discounting by N1 / (N1 + 2 N2).
    """
    n = [0, *often]
    d = np.ones(K + 2)
    least = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    flat = n[1] / (n[1] + 2 * max(n[2], 1)) if n[1] else 0.5
    for r in range(1, K + 1):
        turing = ((r + 1) * n[r + 1] / (r * n[r]) - least) / (1 - least) if n[r] and least < 1 else 0.0
        d[r] = turing if 0 < turing < 1 else (r - flat) / r
    return d


class Statistics:
    """What all tasks share: totals and discounts (a few numbers)."""

    def __init__(self, rows: list) -> None:
        by = {r.gram: r for r in rows}
        one, two = by.get(1), by.get(2)
        self.types, self.tokens = (one.types, one.tokens) if one else (0, 0)
        self.d1 = discounts(one.often if one else [0] * (K + 1))
        self.d2 = discounts(two.often if two else [0] * (K + 1))
        lost = sum((1 - self.d1[r]) * r * n for r, n in enumerate((one.often if one else [])[:K], 1))
        self.n1 = self.tokens if lost > 0 else self.tokens + 1  # without discounted words one more token makes room
        self.unknown = lost / self.tokens if lost > 0 else 1.0 / self.n1


def _class(counts: np.ndarray) -> np.ndarray:
    return np.minimum(counts, K + 1)


PARTIAL = "part string, block long, doc_row int, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, bucket int, keys binary, sums binary, asks binary, docs binary, unseen binary, seen binary"


def _score(buckets: int, s: Statistics):
    """Scores of a block but for backoff weights, its sums over followers, and its requests."""
    names = [x.split()[0] for x in PARTIAL.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), *[pa.binary()] * 6]

    def run(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        row = blocks.to_pylist()[0]
        b = Block(row, buckets)
        replies = replies.sort_by([("gram", "ascending"), ("bucket", "ascending")])
        total, mine = {1: [np.empty(0, np.uint64)], 2: [np.empty(0, np.uint64)]}, {1: [np.empty(0, np.uint8)], 2: [np.empty(0, np.uint8)]}
        for gram, counts, bits in zip(*(replies.column(c).to_pylist() for c in ("gram", "counts", "mine")), strict=True):
            got = unpack_ints(counts, np.uint64)
            total[gram].append(got)
            mine[gram].append(np.unpackbits(np.frombuffer(bits, np.uint8), count=len(got)))
        c1, c2 = (np.concatenate(total[g]).astype(np.int64) for g in (1, 2))
        first2 = np.concatenate(mine[2]).astype(bool) & (c2 > 0)

        token = np.flatnonzero(b.real)  # positions of tokens; the history is the position before
        word, history, pair = b.at[1][token], b.at[1][token - 1], b.at[2]
        text = b.row[token]
        known = c1[word]
        base = np.log10((known + 1) / (s.tokens + s.types + 1))
        n1, n2, nh = known, c2[pair], c1[history]
        with np.errstate(divide="ignore", invalid="ignore"):
            low = np.where(n1 > 0, np.log10(s.d1[_class(n1)] * n1 / s.n1), np.log10(s.unknown))
            high = np.log10(s.d2[_class(n2)] * n2 / nh)
        seen = n2 > 0
        score = np.where(seen, high, low)
        sums = {n: np.bincount(text, w, b.texts) for n, w in (("known", known > 0), ("base", base), ("score", score))}
        rows = [
            ("doc", row["block"], i, b.doc_id[i], b.held[i], int(b.tokens[i]), int(sums["known"][i]), float(sums["base"][i]), float(sums["score"][i]), None, *[None] * 6)
            for i in range(b.texts)
        ]

        # followers of each history that this block is the first to list, by class of the bigram's and of the word's count
        at = b.first[2]
        h, w = history[at], word[at]
        n = len(b.keys[1])
        pairs = np.zeros((2 * (K + 1), n), np.int64)
        for offset, counts in ((0, c2), (K + 1, c1[w])):
            for r in range(1, K + 2):
                own = first2 & (_class(counts) == r)
                pairs[offset + r - 1] = np.bincount(h[own], counts[own] if r > K else None, n)
        told = pairs.any(axis=0)
        # requests: an unseen pair needs its history's weight; where no follower here is discounted, a seen one may need the spare token
        small = np.zeros(n, bool)
        small[h[(c2 > 0) & (c2 <= K)]] = True
        asks = (nh > 0) & (~seen | ~small[history])
        ask, inverse = np.unique(history[asks].astype(np.int64) * max(b.texts, 1) + text[asks], return_inverse=True)
        unseen = np.bincount(inverse, ~seen[asks], len(ask)).astype(np.uint32)
        used = np.bincount(inverse, seen[asks], len(ask)).astype(np.uint32)
        ask_at, ask_doc = ask // max(b.texts, 1), (ask % max(b.texts, 1)).astype(np.uint32)
        for bucket, part in _cuts(b.keys[1]):
            here = np.arange(part.start, part.stop)
            mine_here = here[told[here]]
            lo, hi = np.searchsorted(ask_at, (part.start, part.stop))
            if len(mine_here) or hi > lo:
                rows.append((
                    "sum", row["block"], None, None, None, None, None, None, None, bucket,
                    _pack_keys(b.keys[1][mine_here]), pack_ints(np.concatenate([pairs[:, mine_here].reshape(-1), c1[mine_here]])),
                    _pack_keys(b.keys[1][ask_at[lo:hi]]), pack_ints(ask_doc[lo:hi]), pack_ints(unseen[lo:hi]), pack_ints(used[lo:hi]),
                ))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def backoff(pairs: np.ndarray, count: np.ndarray, s: Statistics) -> tuple[np.ndarray, np.ndarray]:
    """Backoff weight of each history and the tokens added to its count (1 where no follower is discounted).

    ``pairs`` has 2 (K + 1) rows: followers by bigram count 1 to K and the sum of larger counts, then the same by word count.
    """
    r = np.arange(1, K + 1)
    lost = (((1 - s.d2[1 : K + 1]) * r)[:, None] * pairs[:K]).sum(axis=0)
    spare = (lost <= 0).astype(np.int64)
    left = np.where(lost > 0, lost / np.maximum(count, 1), 1.0 / (count + 1))
    lower = ((s.d1[1 : K + 1] * r)[:, None] * pairs[K + 1 : 2 * K + 1]).sum(axis=0) + pairs[2 * K + 1]
    return left / (1.0 - lower / s.n1), spare


WEIGHED = "part string, bucket int, keys binary, weights binary, spare binary, block long, doc_row int, addend double"


def _weigh(s: Statistics):
    """Backoff weights of a bucket's histories (one row of part ``model``) and the addends of the documents that asked for them."""
    names = [x.split()[0] for x in WEIGHED.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.float64()]

    def run(table: pa.Table) -> pa.Table:
        keys, pairs, counts = [np.empty(0, np.uint64)], [np.zeros((2 * (K + 1), 0), np.int64)], [np.empty(0, np.int64)]
        blocks, asks, docs, unseen, seen = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint32)], [np.empty(0, np.uint32)], [np.empty(0, np.uint32)]
        for row in table.select(["block", "keys", "sums", "asks", "docs", "unseen", "seen"]).to_pylist():
            own = _unpack_keys(row["keys"])
            sums = unpack_ints(row["sums"], np.int64).reshape(2 * (K + 1) + 1, len(own))
            keys.append(own), pairs.append(sums[:-1]), counts.append(sums[-1])
            ask = _unpack_keys(row["asks"])
            blocks.append(np.full(len(ask), row["block"])), asks.append(ask)
            for held, name in ((docs, "docs"), (unseen, "unseen"), (seen, "seen")):
                held.append(unpack_ints(row[name], np.uint32))
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        pairs = np.concatenate(pairs, axis=1)
        added = np.stack([np.bincount(at, p, len(distinct)) for p in pairs]) if len(distinct) else pairs
        count = np.zeros(len(distinct), np.int64)
        count[at] = np.concatenate(counts)
        weight, spare = backoff(added, count, s)
        model = pa.table([pa.array([x], t) for x, t in zip(("model", table.column("bucket")[0].as_py(), _pack_keys(distinct), weight.tobytes(), np.packbits(spare.astype(bool)).tobytes(), None, None, None), kinds, strict=True)], names=names)
        block, ask, doc, unseen, seen = (np.concatenate(x) for x in (blocks, asks, docs, unseen, seen))
        if not len(ask):
            return model
        i = np.searchsorted(distinct, ask)  # a history that training saw was listed by some block
        addend = unseen * np.log10(weight[i]) + np.where(spare[i] > 0, seen * np.log10(count[i] / (count[i] + 1)), 0.0)
        pair = np.stack([block, doc.astype(np.int64)])
        order = np.lexsort(pair[::-1])
        pair, addend = pair[:, order], addend[order]
        begin = np.flatnonzero(np.concatenate([[True], (np.diff(pair) != 0).any(axis=0)]))
        n, none = len(begin), [None] * len(begin)
        columns = [["addend"] * n, none, none, none, none, pair[0, begin], pair[1, begin], np.add.reduceat(addend, begin)]
        return pa.concat_tables([model, pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)])

    return run


def _answer(wanted: pa.Table, known: pa.Table) -> pa.Table:
    """For each block's keys of one order and bucket: counts, and for single words the backoff weight and spare token as histories."""
    grams, buckets, blocks = (wanted.column(c).to_pylist() for c in ("gram", "bucket", "block"))
    found = known.to_pylist()
    keys, counts = (_unpack_keys(found[0]["keys"]), unpack_ints(found[0]["counts"], np.uint64)) if found else (np.empty(0, np.uint64), np.empty(0, np.uint64))
    history, weight, spare = np.empty(0, np.uint64), np.empty(0), np.empty(0, np.uint8)
    if found and found[0]["weights"] is not None:
        history, weight = _unpack_keys(found[0]["histories"]), np.frombuffer(found[0]["weights"])
        spare = np.unpackbits(np.frombuffer(found[0]["spare"], np.uint8), count=len(history))

    def look(ask: np.ndarray, have: np.ndarray, values: np.ndarray, otherwise: float) -> np.ndarray:
        if not len(have):
            return np.full(len(ask), otherwise, values.dtype)
        i = np.minimum(np.searchsorted(have, ask), len(have) - 1)
        return np.where(have[i] == ask, values[i], np.array(otherwise, values.dtype))

    told: list[tuple] = []
    for packed in wanted.column("keys"):
        ask = _unpack_keys(packed.as_py())
        bits = np.packbits(look(ask, history, spare, 0)).tobytes()
        told.append((pack_ints(look(ask, keys, counts, 0)), look(ask, history, weight, 1.0).tobytes(), bits))
    columns = [blocks, grams, buckets, *(zip(*told, strict=True) if told else [[]] * 3)]
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["block", "gram", "bucket", "counts", "weights", "spare"])


EVALUATED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _evaluate(buckets: int, s: Statistics):
    names = [x.split()[0] for x in EVALUATED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        b = Block(blocks.to_pylist()[0], buckets)
        count, weight, spare = {1: [np.empty(0, np.uint64)], 2: [np.empty(0, np.uint64)]}, [np.empty(0)], [np.empty(0, np.uint8)]
        for row in replies.sort_by([("gram", "ascending"), ("bucket", "ascending")]).to_pylist():
            count[row["gram"]].append(unpack_ints(row["counts"], np.uint64))
            if row["gram"] == 1:
                weight.append(np.frombuffer(row["weights"]))
                spare.append(np.unpackbits(np.frombuffer(row["spare"], np.uint8), count=len(weight[-1])))
        c1, c2 = (np.concatenate(count[g]).astype(np.int64) for g in (1, 2))
        weight, spare = np.concatenate(weight), np.concatenate(spare)
        token = np.flatnonzero(b.real)
        word, history, text = b.at[1][token], b.at[1][token - 1], b.row[token]
        n1, n2, nh = c1[word], c2[b.at[2]], c1[history]
        with np.errstate(divide="ignore", invalid="ignore"):
            below = np.where(n1 > 0, np.log10(s.d1[_class(n1)] * n1 / s.n1), np.log10(s.unknown))
            own = np.log10(s.d2[_class(n2)] * n2 / (nh + spare[history]))
        p = np.where(n2 > 0, own, below + np.where(nh > 0, np.log10(weight[history]), 0.0))
        base = np.log10((n1 + 1) / (s.tokens + s.types + 1))
        columns = [b.doc_id, b.tokens, np.bincount(text, n1 > 0, b.texts), np.bincount(text, base, b.texts), np.bincount(text, p, b.texts)]
        return pa.table([pa.array(c).cast(t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def _blocked(docs: DataFrame, held_out: str) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr(held_out).alias("held_out"), F.col("text").cast("string").alias("text"))
    return staged(rows.mapInArrow(_blocks, "block long, doc_id array<long>, held_out array<boolean>, starts binary, codes binary, words binary"), "lm-blocks")


ASKED = "bucket int, gram int, block long, keys binary, counts binary"


@dataclass
class Stored:
    """A fitted model. ``counts``: gram, bucket, types, tokens, often, keys, counts. ``weights``: bucket, keys, weights, spare."""

    counts: DataFrame
    weights: DataFrame
    buckets: int

    def statistics(self) -> Statistics:
        often = F.array(*[F.sum(F.element_at("often", r)) for r in range(1, K + 2)]).alias("often")
        return Statistics(self.counts.groupBy("gram").agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens"), often).collect())

    def save(self, path: str) -> None:
        """Write the tables below ``path`` (which must be new), counts by order, and last the number of buckets."""
        self.counts.write.partitionBy("gram").parquet(f"{path}/counts")
        self.weights.write.parquet(f"{path}/weights")
        self.counts.sparkSession.range(1).select(F.lit(self.buckets).alias("buckets")).write.parquet(f"{path}/buckets")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Stored:
        buckets = spark.read.parquet(f"{path}/buckets").first().buckets
        counts = "bucket int, types long, tokens long, often array<long>, keys binary, counts binary, gram int"
        return Stored(spark.read.schema(counts).parquet(f"{path}/counts"), spark.read.schema("bucket int, keys binary, weights binary, spare binary").parquet(f"{path}/weights"), buckets)

    def score(self, docs: DataFrame) -> DataFrame:
        """``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of every text (a null text is empty).

        A bucket's requests are dealt over as many tasks as the texts are larger than the model's buckets allow.
        """
        statistics = self.statistics()
        blocks = _blocked(docs, "true")
        deals = max(1, -(-2 * plan_bytes(blocks) // (self.buckets * BUCKET_BYTES)))  # packed blocks are about half their texts
        asked = blocks.mapInArrow(_requests(self.buckets), ASKED).withColumn("deal", F.pmod("block", F.lit(deals)))
        weights = self.weights.select(F.lit(1).alias("gram"), "bucket", F.col("keys").alias("histories"), "weights", "spare")
        known = self.counts.select("gram", "bucket", "keys", "counts").join(weights, ["gram", "bucket"], "left")
        known = known.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))))
        group = ["gram", "bucket", "deal"]
        answers = asked.groupBy(*group).cogroup(known.groupBy(*group)).applyInArrow(_answer, "block long, gram int, bucket int, counts binary, weights binary, spare binary")
        return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_evaluate(self.buckets, statistics), EVALUATED)


def _learn(docs: DataFrame, held_out: str) -> tuple[Stored, Statistics, DataFrame, DataFrame]:
    """The model, its statistics, and the scores but for backoff weights with the addends that they lack."""
    blocks = _blocked(docs, held_out)
    # the second figure is the smaller one only where Spark has no size of ``docs``, such as for rows from the driver
    buckets = min(bucket_count(docs, BUCKET_BYTES), bucket_count(blocks, BUCKET_BYTES // 4))
    asked = blocks.mapInArrow(_requests(buckets), ASKED)
    counted = staged(asked.groupBy("gram", "bucket").applyInArrow(_count(buckets), COUNTED), "lm-counts", ["part"])
    counts = counted.filter("part = 'model'").select("gram", "bucket", "types", "tokens", "often", "keys", "counts")
    statistics = Stored(counts, counts, buckets).statistics()
    replies = counted.filter("part = 'reply'").select("block", "gram", "bucket", "counts", "mine")
    partial = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_score(buckets, statistics), PARTIAL)
    partial = staged(partial, "lm-partial", ["part"])
    weighed = staged(partial.filter("part = 'sum'").groupBy("bucket").applyInArrow(_weigh(statistics), WEIGHED), "lm-weights", ["part"])
    weights = weighed.filter("part = 'model'").select("bucket", "keys", "weights", "spare")
    addends = weighed.filter("part = 'addend'").groupBy("block", "doc_row").agg(F.sum("addend").alias("addend"))
    return Stored(counts, weights, buckets), statistics, partial.filter("part = 'doc'"), addends


def fit(docs: DataFrame, held_out: str = "false") -> Stored:
    """Train on the rows where the SQL condition ``held_out`` is false. The tables lie in the scratch folder until saved."""
    return _learn(docs, held_out)[0]


def score(docs: DataFrame, held_out: str) -> DataFrame:
    """Train on the rows where the SQL condition ``held_out`` is false, and score every text (a null text is empty).

    Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one unigram) and
    ``score`` (log10 probability of the words and the end). A-Z are lower-cased. Rows whose condition is null teach
    nothing. Rows that repeat a doc_id are scored each by its own text.
    """
    _, statistics, partial, addends = _learn(docs, held_out)
    scored = partial.select("block", "doc_row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")
    both = scored.join(addends, ["block", "doc_row"], "left")
    return both.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(statistics.tokens).cast("long").alias("train_tokens"), "base_score",
        (F.col("score") + F.coalesce("addend", F.lit(0.0))).alias("score"),
    )
