"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into windows of ``WINDOW`` words (an item of fewer words is one window). A window is
a set of shingles (runs of up to three words), and a text contains the window only if it holds all of
them. So the necessary prefix of a window is one shingle, and the rarest one over all documents is
taken: shingle counts come from a first pass over the documents. In the second pass every shingle of
a text that is some window's prefix proposes one place for that window (its offset in the window
fixes it, so at most one place per match), places where the window would leave the text are dropped
by length, and the words are compared exactly.

The benchmark travels in parts of at most ``PART_BYTES`` of words each; a larger benchmark means more
passes over the documents, never a larger broadcast. No shuffle moves a document: a document's hits
of all parts meet as word numbers only.

Defined results: null text has no words; an item without words is never found; items with one
item_id count once; repeated documents are judged row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldguard.llm import words as W

WINDOW, SHINGLE = 10, 3
PART_BYTES = 8 << 20
_CHUNK = 1 << 20


@dataclass
class Index:
    """Windows of one part of the benchmark."""

    ids: list  # item ids as strings, by item
    window: list[bytes]  # the words of each window, joined by one space
    item: np.ndarray  # item of each window
    length: np.ndarray  # words of each window
    shingles: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    # by shingle size: sorted hashes, window and offset of every shingle of every window


def _item_windows(texts: pa.Array, window: int):
    found = W.find_words(*W.text_arrays(texts), W.ALNUM, W.LOWER)
    for d, (low, n) in enumerate(zip(found.first[:-1], found.counts, strict=True)):
        for at in range(low, low + max(1, n - window + 1) if n else low):
            yield d, found, at, min(window, int(n))


def build(items: list[tuple[str, str]], window: int = WINDOW, shingle: int = SHINGLE) -> Index:
    """All windows of the items and the hashes of their shingles; equal windows of an item once."""
    texts = pa.array([t for _, t in items], pa.string())
    seen, windows, owner, length = set(), [], [], []
    parts: dict[int, list] = {}
    for d, found, at, size in _item_windows(texts, window):
        said = found.joined(np.arange(at, at + size))
        if (d, said) in seen:
            continue
        seen.add((d, said))
        k = min(shingle, size)
        hashes = W.rolling(found.hash[at : at + size], k)
        parts.setdefault(k, []).append((hashes, len(windows)))
        windows.append(said)
        owner.append(d)
        length.append(size)
    shingles = {}
    for k, rows in parts.items():
        hashes = np.concatenate([h for h, _ in rows])
        of = np.repeat([w for _, w in rows], [len(h) for h, _ in rows])
        offset = np.concatenate([np.arange(len(h)) for h, _ in rows])
        order = np.argsort(hashes, kind="stable")
        shingles[k] = hashes[order], of[order], offset[order]
    return Index([i for i, _ in items], windows, np.array(owner, np.int64), np.array(length, np.int64), shingles)


def _spans(found: W.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    places = np.flatnonzero(W.same_text(found, k))
    return W.rolling(found.hash, k)[places], places


def count_shingles(index) -> callable:
    """Task side of the first pass: how often each shingle of the benchmark occurs in the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = {k: np.unique(s[0]) for k, s in index.value.shingles.items()}
        totals = {k: np.zeros(len(v), np.int64) for k, v in values.items()}
        for batch in W.pieces(batches, limit=_CHUNK):
            found = W.find_words(*W.text_arrays(batch.column("text")), W.ALNUM, W.LOWER)
            for k, known in values.items():
                hashes, _ = _spans(found, k)
                at = np.searchsorted(known, hashes)
                at[at == len(known)] = 0
                totals[k] += np.bincount(at[known[at] == hashes], minlength=len(known))
        for k, known in values.items():
            seen = totals[k] > 0
            yield pa.RecordBatch.from_pydict(
                {
                    "k": pa.array(np.full(seen.sum(), k), pa.int32()),
                    "hash": pa.array(known[seen].view(np.int64)),
                    "n": pa.array(totals[k][seen]),
                }
            )

    return W.tidy(run)


def rarest(index: Index, counts: dict[int, dict[int, int]]) -> dict:
    """By shingle size: the prefix of every window, sorted by hash: hashes, window, offset."""
    out = {}
    for k, (hashes, window, offset) in index.shingles.items():
        n = np.array([counts.get(k, {}).get(h, 0) for h in hashes.view(np.int64).tolist()])
        # A shingle nowhere in the documents proves its window absent: the window needs no prefix.
        order = np.lexsort((offset, hashes, n, window))
        first = np.append(True, window[order][1:] != window[order][:-1]) if len(order) else order
        picked = order[np.asarray(first, bool)]
        picked = picked[n[picked] > 0]
        picked = picked[np.argsort(hashes[picked], kind="stable")]
        out[k] = hashes[picked], window[picked], offset[picked]
    return out


def find_hits(index, prefix):
    """Task side of the second pass: adds this part's hits to ``_runs`` (start, length, ...) and ``_items``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in W.pieces(batches, limit=_CHUNK):
            found = W.find_words(*W.text_arrays(batch.column("text")), W.ALNUM, W.LOWER)
            runs, items = batch.column("_runs").to_pylist(), batch.column("_items").to_pylist()
            _verify(found, known, prefix.value, runs, items)
            made = {
                "_words": pa.array(found.counts, pa.int64()),
                "_runs": pa.array(runs, pa.list_(pa.int64())),
                "_items": pa.array(items, pa.list_(pa.string())),
            }
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([made.get(n, batch.column(n)) for n in names], names=names)

    return W.tidy(run)


def _verify(found: W.Words, known: Index, prefix: dict, runs: list, items: list) -> None:
    """Adds to each text's runs (start, words, ...) and items what occurs in it; runs that touch become one."""
    first = found.first
    hit: dict[int, list[tuple[int, int]]] = {}
    held: dict[int, dict] = {}
    for k, (keys, window, offset) in prefix.items():
        hashes, places = _spans(found, k)
        low = np.searchsorted(keys, hashes, side="left")
        high = np.searchsorted(keys, hashes, side="right")
        for i in np.flatnonzero(high > low):
            d = int(found.doc[places[i]])
            for j in range(low[i], high[i]):
                at, size = int(places[i] - offset[j]), int(known.length[window[j]])
                if at < first[d] or at + size > first[d + 1]:
                    continue
                if found.joined(range(at, at + size)) == known.window[window[j]]:
                    begin = at - int(first[d])
                    hit.setdefault(d, []).append((begin, begin + size))
                    held.setdefault(d, {})[known.ids[known.item[window[j]]]] = None
    for d, spans in hit.items():
        merged: list[list[int]] = []
        for begin, end in sorted(spans):
            if merged and begin <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([begin, end])
        runs[d] = [*runs[d], *(x for begin, end in merged for x in (begin, end - begin))]
        items[d] = [*items[d], *held[d]]


def _covered(runs: Column) -> Column:
    """Words in any of the runs."""
    count = F.size(runs) / 2
    places = F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    at = lambda i, k: F.element_at(runs, 2 * i + k)
    words = F.flatten(F.transform(places, lambda i: F.sequence(at(i, 1), at(i, 1) + at(i, 2) - 1)))
    return F.size(F.array_distinct(words)).cast("long")


def _parts(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, str]]]:
    """Items in parts of bounded size (one item at least); the driver holds a part at a time."""
    part, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text").where(
        "item_id IS NOT NULL AND text IS NOT NULL"
    )
    for item, text in rows.distinct().toLocalIterator():
        part.append((item, text))
        size += WINDOW * len(text)  # a list of windows holds a word about WINDOW times
        if size >= limit:
            yield part
            part, size = [], 0
    yield part


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES, keep: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_words, n_hit, items (the found item ids, sorted as strings), and the ``keep`` columns."""
    sc = docs.sparkSession.sparkContext
    plain = docs.select("text")
    found = docs.select(
        F.col("doc_id").alias("_id"),
        "text",
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
        F.lit(0).cast("long").alias("_words"),
        F.array().cast("array<long>").alias("_runs"),
        F.array().cast("array<string>").alias("_items"),
    )
    for part in _parts(benchmark, part_bytes):
        index = build(part)
        shared = sc.broadcast(index)
        tallied = plain.mapInArrow(count_shingles(shared), "k int, hash long, n long")
        counts: dict[int, dict[int, int]] = {}
        # At most the shingles of the part, whose size is bounded.
        for k, value, n in tallied.groupBy("k", "hash").agg(F.sum("n")).collect():
            counts.setdefault(k, {})[value] = n
        prefix = sc.broadcast(rarest(index, counts))
        found = found.mapInArrow(find_hits(shared, prefix), found.schema)
    return found.select(
        F.col("_id").alias("doc_id"),
        F.col("_words").alias("n_words"),
        _covered(F.col("_runs")).alias("n_hit"),
        F.array_sort(F.array_distinct("_items")).alias("items"),
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
    )
