"""Word blocks: whole texts of one Arrow batch as integer codes.

Several operators need the words of whole texts as numbers. ``word_block`` splits the texts of a batch with Arrow's
compiled kernels, codes each distinct word once and hashes only the distinct words, so the per-word work stays in
vectorised code. A block never outlives its batch, and ``bounded`` re-cuts batches so that a block of very long texts
stays small (one text is the least unit).

Words are ``[^\\x20\\x09-\\x0D]+``. A null text has no words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 4 << 20


@dataclass
class WordBlock:
    """``codes[starts[i]:starts[i + 1]]`` are the words of text ``i``; ``words[code]`` and ``hashes[code]`` describe a code."""

    starts: np.ndarray  # int64, one more than texts
    codes: np.ndarray  # int32
    words: pa.Array  # distinct words
    hashes: np.ndarray  # uint64, one per distinct word

    @property
    def rows(self) -> np.ndarray:
        """Text number of every word."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def pieces(texts: pa.Array, most: int = BLOCK_BYTES) -> list[tuple[int, int]]:
    """Consecutive ranges of texts that hold about ``most`` bytes each; a longer text ends its range."""
    if not len(texts):
        return []
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.maximum(np.cumsum(sizes) - 1, 0) // most
    cuts = (np.flatnonzero(np.diff(part)) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(texts)], strict=True))


def bounded(batches: Iterable[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches by the sizes of their texts (see ``pieces``). Memory that a batch leaves free goes back to the system."""
    for batch in batches:
        for a, b in pieces(batch.column(column), most):
            yield batch.slice(a, b - a)
        give_back()


def give_back() -> None:
    """Return freed memory to the system: a reused Python worker otherwise keeps the peak of every stage that it has run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def word_block(texts: pa.Array, lower: bool = False) -> WordBlock:
    """Words of each text. ``lower`` maps A-Z to a-z and leaves every other character alone."""
    if texts.offset:  # the case kernel reads a slice's offsets from its parent's start: copy the slice
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = texts.cast(pa.large_string()).fill_null("")
    if lower:
        texts = pc.ascii_lower(texts)
    split = pc.ascii_split_whitespace(texts)
    values = split.flatten()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]).astype(np.int64)
    full = pc.not_equal(values, "").to_numpy(zero_copy_only=False)
    if not full.all():
        starts = np.concatenate([[0], np.cumsum(full)])[starts].astype(np.int64)
        values = values.filter(pa.array(full))
    coded = values.dictionary_encode()
    words = coded.dictionary
    return WordBlock(starts, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), words, hash_words(words))


def hash_words(words: pa.Array) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words.to_pylist()), dtype=np.uint64, count=len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public constants of the splitmix generator)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the ``n`` consecutive word hashes that begin at each position (positions that hold a whole gram)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = mix64(hashes[:m] + np.uint64(n))
    for i in range(1, n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + m])
    return out


def inside(starts: np.ndarray, n: int) -> np.ndarray:
    """Which positions of the concatenated texts begin ``n`` words of one text (length: total words - n + 1)."""
    total = int(starts[-1])
    ok = np.zeros(total + 1, bool)
    lengths = np.diff(starts)
    step = np.zeros(total + 2, np.int32)
    has = lengths >= n
    np.add.at(step, starts[:-1][has], 1)
    np.add.at(step, starts[1:][has] - n + 1, -1)
    ok = np.cumsum(step[: max(total - n + 1, 0)]) > 0
    return ok
