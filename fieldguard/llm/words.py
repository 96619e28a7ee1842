"""Words of Arrow text columns as numpy arrays: places, numbers by content and 64-bit hashes.

Words are told apart by their bytes (Arrow's dictionary encoding), so two words of a batch share a number only
if they are equal. A word's hash is xxh3 of its bytes, taken once per distinct word; it is what travels
between tasks. No loop runs over all words in Python.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress
from dataclasses import dataclass
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_ODD = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 20


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


# Words between ASCII white space. No byte of a multi-byte character is in the set, so bytes do.
SPACED = ~_byte_set((0x20, 0x20), (0x09, 0x0D))
# Words of ASCII letters and digits and of all that is not ASCII.
ALNUM = _byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
SAME = np.arange(256, dtype=np.uint8)
LOWER = np.where((SAME >= 0x41) & (SAME <= 0x5A), SAME + 32, SAME).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, each value on its own."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def _bytes_to_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    up = np.full(size, _ODD, np.uint64)
    down = np.full(size, pow(_ODD, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@dataclass
class Words:
    """The words of some texts, in order. ``start`` and ``end`` are byte offsets in ``data``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    counts: np.ndarray
    hash: np.ndarray
    # The distinct words (large_binary), and for each word which of them it is.
    distinct: pa.Array
    number: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """For each text the number of its first word; one more entry at the end."""
        return np.concatenate([[0], np.cumsum(self.counts)])

    def joined(self, picked: np.ndarray) -> bytes:
        """The bytes of the picked words with one space between them."""
        data, start, end = self.data, self.start, self.end
        return b" ".join([data[start[i] : end[i]].tobytes() for i in picked])


def find_words(
    data: np.ndarray,
    offsets: np.ndarray,
    is_word: np.ndarray,
    fold: np.ndarray = SAME,
    hashed: bool = True,
    numbered: bool = True,
) -> Words:
    """Words are maximal runs of bytes in ``is_word`` inside one text; ``fold`` maps bytes first.

    ``offsets`` (one more than texts) must start at 0. Without ``hashed`` there are no hashes, without
    ``numbered`` neither hashes nor numbers: places only.
    """
    data = data[: offsets[-1]]
    if fold is not SAME:
        data = fold[data]
    inside = is_word[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    doc = np.searchsorted(offsets[1:], start, side="right")
    counts = np.bincount(doc, minlength=len(offsets) - 1)
    if not numbered:
        return Words(data, start, end, doc, counts, np.empty(0, np.uint64), pa.array([], pa.large_binary()), np.empty(0, np.int32))
    places = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    # The words are what lies inside, one after the other.
    said = pa.py_buffer(np.ascontiguousarray(data[inside]))
    coded = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(places), said]).dictionary_encode()
    distinct, number = coded.dictionary, coded.indices.to_numpy()
    known = np.empty(0, np.uint64)
    if hashed:
        known = _content_hashes(distinct)[number]
    return Words(data, start, end, doc, counts, known, distinct, number)


content_hash = xxhash.xxh3_64_intdigest


def _content_hashes(said: pa.LargeBinaryArray) -> np.ndarray:
    """The hash of every value, cut from one run of bytes: Arrow's own values take longer than the hashes."""
    if not len(said):
        return np.empty(0, np.uint64)
    _, where, raw = said.buffers()
    ends = np.frombuffer(where, np.int64)[said.offset : said.offset + len(said) + 1].tolist()
    run = raw.to_pybytes()
    return np.fromiter((content_hash(run[a:b]) for a, b in pairwise(ends)), np.uint64, len(said))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    values = _bytes_to_values()
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        base = start[at]
        to = max(at + 1, int(np.searchsorted(end, base + _BLOCK, side="right")))
        size = int(end[to - 1] - base)
        up, down = _powers(max(_BLOCK, 1 << (size - 1).bit_length()))
        sums = np.empty(size + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[data[base : base + size]] * up[:size], out=sums[1:])
        low, high = start[at:to] - base, end[at:to] - base
        out[at:to] = (sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64)
        at = to
    return mix(out)


def rolling(hashes: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Hash of every run of ``size`` words, by its first word. Runs may cross texts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factor = np.uint64((seed * 0xD1342543DE82EF95) % (1 << 64) | 1)
    out = hashes[:n].copy()
    for i in range(1, size):
        out *= factor
        out += hashes[i : i + n]
    return mix(out)


def same_text(words: Words, size: int) -> np.ndarray:
    """Whether the run of ``size`` words that begins at each word stays in its text."""
    n = max(0, len(words.doc) - size + 1)
    return words.doc[:n] == words.doc[size - 1 : size - 1 + n]


def text_arrays(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, where, raw = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(
    batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each hold about ``limit`` bytes, one text at least.

    After the last one, memory that is free goes back to the system: workers serve many stages.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = min(batch.num_rows, max(at + 1, to))
            yield batch.slice(at, to - at)
            at = to
        del batch, sizes, offsets
        pa.default_memory_pool().release_unused()
    give_back()


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's work that gives memory back once all it held is gone: idle workers stay for other stages."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc keeps freed memory, and only it has the call
        ctypes.CDLL(None).malloc_trim(0)
