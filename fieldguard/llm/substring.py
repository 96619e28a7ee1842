"""Substring dedup with fixed-block anchors.

Non-overlapping reference blocks of every text are indexed by their hash; every rolling block of
every text probes the index. Any repeat of ``window`` words holds a whole reference block of its
earlier place if ``2 * block - 1 <= window``, so hits find all repeats. A hit is then extended: all
windows around it are compared by content, and of equal windows the earliest place stays. Runs of
such windows are the maximal exact repeats.

Both comparisons are shuffles by hash, packed into a few binary rows per task and bucket. What
repeats inside a task's piece is settled there, so a text copied any number of times reaches a
bucket once per piece.

Defined results: null text has no words. Repeated rows with one doc_id and text are one place, so
neither removes the other. A null doc_id counts as the largest. Columns other than doc_id and text
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldguard.llm import exchange, words as W

BLOCK, WINDOW = 10, 20
# Bytes of a probe's hash that travel. The bucket adds its own bits; chance hits only cost time.
PROBE_BYTES = 5
PIECE = 12 << 20
_NO_ID = np.iinfo(np.int64).max
_ASK = "bucket int, piece long, ids binary, versions binary, first binary, hashes binary, more binary, places binary, known binary"
_ANSWER = "piece long, ids binary, versions binary, first binary, places binary"
_FOUND = "id long, version long, places binary"


def keyed(docs: DataFrame) -> DataFrame:
    """id, version, text: the version tells rows apart that share an id."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64("text").alias("version"),
        F.col("text"),
    )


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("id").to_numpy(), batch.column("version").to_numpy()


def _piece_id(ids: np.ndarray, versions: np.ndarray) -> int:
    digest = hashlib.blake2b(ids.tobytes() + versions.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _asks(
    ids: np.ndarray,
    versions: np.ndarray,
    found: W.Words,
    hashes: np.ndarray,
    more: np.ndarray,
    places: np.ndarray,
    known: np.ndarray,
    count: int,
    width: int,
) -> pa.RecordBatch:
    """One row per bucket for the entries, one row (bucket of its own) for what is known already."""
    piece = _piece_id(ids, versions)
    buckets = ((hashes >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
    order, cuts = exchange.by_bucket(buckets, count)
    hashes, more, places = hashes[order], more[order], places[order]
    packed_ids, first = ids.tobytes(), exchange.pack(found.first)
    packed_ids = exchange.zstandard.ZstdCompressor(level=1).compress(packed_ids)
    out = {k: [] for k in ("bucket", "piece", "ids", "versions", "first", "hashes", "more", "places", "known")}

    def row(*values) -> None:
        for k, v in zip(out, values, strict=True):
            out[k].append(v)

    row(abs(piece) % count, piece, packed_ids, versions.tobytes(), first, None, None, None, exchange.pack(known))
    for b in np.flatnonzero(np.diff(cuts)):
        at = slice(cuts[b], cuts[b + 1])
        row(
            int(b), piece, packed_ids, None, first, exchange.cut_bytes(hashes[at], width),
            more[at].tobytes(), exchange.pack(places[at]), None,
        )
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 7]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out)
    )


def _plain_ids(blob: bytes) -> np.ndarray:
    return np.frombuffer(exchange.zstandard.ZstdDecompressor().decompress(blob), np.int64)


def probe(block: int, count: int):
    """Task side of the first shuffle: rolling blocks, marked where they are reference blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, limit=PIECE):
            found = W.find_words(*W.text_arrays(batch.column("text")), W.SPACED)
            hashes = W.rolling(found.hash, block)
            places = np.flatnonzero(W.same_text(found, block))
            hashes = hashes[places]
            reference = (places - found.first[found.doc[places]]) % block == 0
            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            new = np.ones(len(order), bool)
            new[1:] = ranked[1:] != ranked[:-1]
            heads = np.flatnonzero(new)
            sizes = np.diff(np.append(heads, len(order)))
            repeated = np.repeat(sizes > 1, sizes)
            known = np.sort(places[order[repeated]])
            any_reference = (
                np.maximum.reduceat(reference[order], heads) if len(heads) else reference[:0]
            )
            keep = order[heads]
            by_place = np.argsort(keep)
            yield _asks(
                *_ids(batch), found, ranked[heads][by_place], any_reference[by_place].astype(np.uint8),
                places[keep[by_place]], known, count, PROBE_BYTES,
            )

    return run


def _reply(table: pa.Table, kept: list[np.ndarray], rows: list[int]) -> pa.Table:
    """Answers to the asking rows, and the rows of what was known."""
    known = [i for i, v in enumerate(table.column("known").to_pylist()) if v is not None]
    info = table.take(pa.array(known, pa.int64()))
    asked = table.take(pa.array(rows, pa.int64()))
    none = pa.nulls(len(rows), pa.binary())
    parts = [
        [info.column(k).combine_chunks() for k in ("piece", "ids", "versions", "first", "known")],
        [asked.column("piece").combine_chunks(), none, none, none, pa.array([exchange.pack(x) for x in kept], pa.binary())],
    ]
    names = ["piece", "ids", "versions", "first", "places"]
    return pa.concat_tables([pa.Table.from_arrays(p, names=names) for p in parts])


def _entries(table: pa.Table, width: int):
    asks = [i for i, v in enumerate(table.column("hashes").to_pylist()) if v is not None]
    asked = table.take(pa.array(asks, pa.int64()))
    hashes = [exchange.whole_hashes(x, width) for x in asked.column("hashes").to_pylist()]
    places = [exchange.unpack(x) for x in asked.column("places").to_pylist()]
    more = asked.column("more").to_pylist()
    owner = np.repeat(np.arange(len(asks)), [len(x) for x in places])
    return asked, asks, hashes, places, more, owner


def _answers(table, asks, places, owner, picked) -> pa.Table:
    """``picked`` entries, by the row that asked."""
    cuts = np.searchsorted(owner, np.arange(len(asks) + 1))
    kept, rows = [], []
    for i, row in enumerate(asks):
        own = places[i][picked[cuts[i] : cuts[i + 1]]]
        if len(own):
            kept.append(own)
            rows.append(row)
    return _reply(table, kept, rows)


def match(table: pa.Table) -> pa.Table:
    """Bucket side of the first shuffle: probes that meet a reference block at another place."""
    _, asks, hashes, places, more, owner = _entries(table, PROBE_BYTES)
    picked = np.zeros(len(owner), bool)
    if len(owner):
        values = np.concatenate(hashes)
        reference = np.concatenate([np.frombuffer(x, np.uint8) for x in more])
        order = np.argsort(values)
        ranked = values[order]
        heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        sizes = np.diff(np.append(heads, len(order)))
        hit = (sizes > 1) & (np.maximum.reduceat(reference[order], heads) > 0)
        picked[order[np.repeat(hit, sizes)]] = True
    return _answers(table, asks, places, owner, picked)


def extend(block: int, window: int, count: int):
    """Task side of the second shuffle: the windows around hits, earliest of each per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, limit=PIECE):
            found = W.find_words(*W.text_arrays(batch.column("text")), W.SPACED)
            first, n = found.first, len(found.hash)
            hits = [
                exchange.unpack(x) + first[i] for i, x in enumerate(batch.column("places").to_pylist())
            ]
            hits = np.concatenate(hits) if hits else np.empty(0, np.int64)
            marks = np.zeros(n + 1, np.int64)
            np.add.at(marks, np.maximum(hits - (window - block), 0), 1)
            np.add.at(marks, hits + 1, -1)
            near = np.cumsum(marks)[:n] > 0
            whole = W.same_text(found, window)
            places = np.flatnonzero(near[: len(whole)] & whole)
            one = W.rolling(found.hash, window)[places]
            two = W.rolling(found.hash, window, seed=3)[places] >> np.uint64(32)
            ids, versions = _ids(batch)
            doc = found.doc[places]
            offset = places - first[doc]
            order = np.lexsort((offset, ids[doc], two, one))
            later, same = _later(one[order], two[order], ids[doc][order], offset[order])
            known = np.sort(places[order[later]])
            keep = np.sort(order[~later])
            yield _asks(
                ids, versions, found, one[keep], two[keep].astype(np.uint32), places[keep], known,
                count, 8,
            )

    return run


def _later(one, two, ids, offset) -> tuple[np.ndarray, np.ndarray]:
    """Of entries sorted by content and place: which have an equal one at an earlier place."""
    if not len(one):
        return np.zeros(0, bool), np.zeros(0, bool)
    new = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
    heads = np.flatnonzero(new)
    head = heads[np.cumsum(new) - 1]
    return (ids != ids[head]) | (offset != offset[head]), new


def earliest(table: pa.Table) -> pa.Table:
    """Bucket side of the second shuffle: places whose window also starts earlier."""
    asked, asks, hashes, places, more, owner = _entries(table, 8)
    picked = np.zeros(len(owner), bool)
    if len(owner):
        ids, offsets = [], []
        for i, (blob, first) in enumerate(
            zip(asked.column("ids").to_pylist(), asked.column("first").to_pylist(), strict=True)
        ):
            first = exchange.unpack(first)
            doc = np.searchsorted(first, places[i], side="right") - 1
            ids.append(_plain_ids(blob)[doc])
            offsets.append(places[i] - first[doc])
        one, two = np.concatenate(hashes), np.concatenate([np.frombuffer(x, np.uint32) for x in more])
        ids, offsets = np.concatenate(ids), np.concatenate(offsets)
        order = np.lexsort((offsets, ids, two, one))
        later, _ = _later(one[order], two[order], ids[order], offsets[order])
        picked[order[later]] = True
    return _answers(table, asks, places, owner, picked)


def gather(table: pa.Table) -> pa.Table:
    """All answers to one piece, by document; places become word numbers in the document."""
    rows = table.to_pylist()
    ids, versions, places = [], [], []
    all_places = np.unique(np.concatenate([exchange.unpack(r["places"]) for r in rows]))
    info = next(r for r in rows if r["ids"] is not None and r["versions"] is not None)
    first = exchange.unpack(info["first"])
    plain, own = _plain_ids(info["ids"]), np.frombuffer(info["versions"], np.int64)
    doc = np.searchsorted(first, all_places, side="right") - 1
    for d in np.unique(doc):
        ids.append(plain[d])
        versions.append(own[d])
        low, high = np.searchsorted(doc, [d, d + 1])
        places.append(exchange.pack(all_places[low:high] - first[d]))
    return pa.table(
        {"id": pa.array(ids, pa.int64()), "version": pa.array(versions, pa.int64()), "places": pa.array(places, pa.binary())}
    )


def _answered(asks: DataFrame, decide) -> DataFrame:
    """id, version, places (one row per document that has any)."""
    answers = asks.groupBy("bucket").applyInArrow(decide, _ANSWER)
    found = answers.groupBy("piece").applyInArrow(gather, _FOUND)
    # Rows repeated with one id and text ask twice and are answered alike.
    return found.groupBy("id", "version").agg(F.max("places").alias("places"))


def repeated_windows(docs: DataFrame, block: int = BLOCK, window: int = WINDOW) -> DataFrame:
    """id, version, places: the starts of windows whose words also start earlier."""
    if 2 * block - 1 > window:
        raise ValueError("a window must be sure to hold a whole reference block")
    count = exchange.bucket_count(docs.sparkSession)
    docs = keyed(docs)
    hits = _answered(docs.mapInArrow(probe(block, count), _ASK), match)
    near = docs.join(hits, ["id", "version"])
    return _answered(near.mapInArrow(extend(block, window, count), _ASK), earliest)


def strip(window: int):
    """Task side of the result: words without those that repeated windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, limit=PIECE):
            data, offsets = W.text_arrays(batch.column("text"))
            found = W.find_words(data, offsets, W.SPACED)
            first, n = found.first, len(found.hash)
            marks = np.zeros(n + 1, np.int64)
            for i, blob in enumerate(batch.column("places").to_pylist()):
                if blob is not None:
                    starts = exchange.unpack(blob) + first[i]
                    marks[starts] += 1
                    marks[starts + window] -= 1
            gone = np.cumsum(marks)[:n] > 0
            removed = np.bincount(found.doc[gone], minlength=len(found.counts))
            ids = batch.column("id").to_numpy()
            kept = _kept_texts(data, offsets, found, ~gone)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64(), mask=ids == _NO_ID),
                    pa.array(found.counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return run


def _kept_texts(data, offsets, found: W.Words, kept: np.ndarray) -> list[str]:
    """For each text its kept words with one space between: byte runs cut in one go."""
    marks = np.zeros(len(data) + 1, np.int8)
    ends = found.end[kept]
    last = offsets[1:][found.doc[kept]]
    plain = data.copy()
    spaced = ends < last
    plain[ends[spaced]] = 0x20
    np.add.at(marks, found.start[kept], 1)
    np.add.at(marks, ends + spaced, -1)
    inside = np.cumsum(marks[:-1], dtype=np.int8) > 0
    out = plain[inside].tobytes()
    cuts = np.concatenate([[0], np.cumsum(inside)])[offsets]
    return [
        out[a:b].removesuffix(b" ").decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]


def dedup_substrings(docs: DataFrame, block: int = BLOCK, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text: each text without words of repeated windows."""
    removed = repeated_windows(docs, block, window)
    # The texts are dealt by the same key as for extending, so that Spark shuffles them once.
    joined = keyed(docs).join(removed, ["id", "version"], "left")
    return joined.mapInArrow(
        strip(window), "doc_id long, n_words long, n_removed long, kept_text string"
    )
