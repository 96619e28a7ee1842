"""Exact top-k by inner product over an impact-ordered index, score at a time.

The postings (vector, dimension, impact) of a chunk of vectors are cut into segments by quantised
impact: each holds the components whose size lies between two powers of two. Segments are processed
in falling order of impact for all queries at once. After each one the rest of a vector can add at
most |query| * |rest of the vector| to its score. Processing stops only when few vectors can still
reach the k-th best lower bound (scores found in earlier chunks count too); these possible members
are scored exactly in whole numbers, so the result is exact whatever was skipped.

Queries go out in blocks of at most ``BLOCK_BYTES``; every block passes over all vectors, and k rows
per query and task are merged. There is no join of queries with vectors.

Defined results: vectors that are null or hold null, NaN or infinite components take no part, nor do
rows with a null id; an empty vector scores 0; vectors of different length count missing components
as 0; equal scores go to the smaller id, and repeated rows count as rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K, SCALE = 5, 256
BLOCK_BYTES = 4 << 20
CHUNK, QUERIES_AT_ONCE = 2048, 1024
# Scoring is cheaper than another segment once this share of the pairs is possible.
FEW = 0.02
_FOUND = "query_row long, query_id long, vec_id long, score long"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (whole numbers): rows that take part."""
    x = F.col("embedding")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & good).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v")
    )


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    sizes = np.diff(lists.offsets.to_numpy()[: len(lists) + 1])
    flat = lists.flatten().to_numpy()
    inside = np.arange(width)[None, :] < np.minimum(sizes, width)[:, None]
    if (sizes <= width).all():
        out[inside] = flat
    else:
        for i, row in enumerate(lists.to_pylist()):
            out[i, : min(width, len(row))] = row[:width]
    return out


def segments(vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Impact segments in falling order: the components in each, and the norm of all later ones."""
    size = np.abs(vectors)
    rest = (vectors.astype(np.float64) ** 2).sum(axis=1)
    high = int(size.max(initial=0)).bit_length()
    edges = [e for e in (high - 1, high - 2, high - 3) if e > 0]
    above = np.inf
    for edge in [*(1 << e for e in edges), 0]:
        inside = (size >= edge) & (size < above)
        part = np.where(inside, vectors, 0).astype(np.float64)
        rest = np.maximum(rest - (part**2).sum(axis=1), 0)
        above = edge
        yield part, np.sqrt(rest)


def possible(queries: np.ndarray, vectors: np.ndarray, best: np.ndarray, k: int):
    """Pairs (query, vector) that may be among the k best; ``best``: a score known to be reached."""
    norm = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    plain = queries.astype(np.float64)
    scores = np.zeros((len(queries), len(vectors)))
    for part, rest in segments(vectors):
        scores += plain @ part.T
        # A margin for the rounding of sums in floating point.
        slack = np.outer(norm, rest) + 1e-9 * np.outer(norm, np.abs(part).sum(axis=1) + rest + 1) + 0.5
        low = scores - slack
        if len(vectors) > k:
            reached = np.partition(low, len(vectors) - k - 1, axis=1)[:, -k - 1]
            best = np.maximum(best, reached)
        open_ = scores + slack >= best[:, None]
        if open_.mean() <= FEW:
            break
    return np.nonzero(open_)


def search(block, k: int):
    """Task side: the k best vectors of the task's rows for every query of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, ids, queries = block.value
        width = queries.shape[1]
        best = [(np.empty(0, np.int64),) * 3 for _ in range(0, len(ids), QUERIES_AT_ONCE)]
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                vec_ids = part.column("vec_id").to_numpy()
                vectors = _matrix(pa.concat_arrays([part.column("v")]), width)
                for b, low in enumerate(range(0, len(ids), QUERIES_AT_ONCE)):
                    own = queries[low : low + QUERIES_AT_ONCE]
                    best[b] = _merge(best[b], ids[low : low + QUERIES_AT_ONCE], own, vec_ids, vectors, k)
        for b, low in enumerate(range(0, len(ids), QUERIES_AT_ONCE)):
            q, v, s = best[b]
            yield pa.RecordBatch.from_pydict(
                {"query_row": first + low + q, "query_id": ids[low + q], "vec_id": v, "score": s}
            )

    return run


def _merge(best, ids, queries, vec_ids, vectors, k: int):
    q, v, s = best
    reached = np.full(len(ids), -np.inf)
    counts = np.bincount(q, minlength=len(ids))
    last = np.cumsum(counts) - 1
    reached[counts == k] = s[last[counts == k]]
    pq, pv = possible(queries, vectors, reached, k)
    other = ids[pq] != vec_ids[pv]
    pq, pv = pq[other], pv[other]
    exact = np.einsum("ij,ij->i", queries[pq], vectors[pv])
    q, v, s = np.concatenate([q, pq]), np.concatenate([v, vec_ids[pv]]), np.concatenate([s, exact])
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    first = np.searchsorted(q, np.arange(len(ids)))
    keep = np.arange(len(q)) - first[q] < k
    return q[keep], v[keep], s[keep]


def _blocks(queries: DataFrame, limit: int) -> Iterator[tuple[np.ndarray, list]]:
    """Queries in blocks of bounded size; the driver holds one at a time."""
    ids, rows, size = [], [], 0
    for vec_id, v in queries.toLocalIterator():
        ids.append(vec_id)
        rows.append(v)
        size += 8 * (len(v) + 1)
        if size >= limit:
            yield ids, rows
            ids, rows, size = [], [], 0
    if ids:
        yield ids, rows


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each query (both: vec_id, embedding)."""
    spark = vectors.sparkSession
    vectors, queries = usable(vectors), usable(queries)
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 1
    found = spark.createDataFrame([], _FOUND)
    first = 0  # query rows are numbered, so that rows with one id are queries of their own
    for ids, rows in _blocks(queries, block_bytes):
        matrix = np.zeros((len(rows), max(1, width)), np.int64)
        for i, row in enumerate(rows):
            matrix[i, : min(len(row), width)] = row[:width]
        block = spark.sparkContext.broadcast((first, np.array(ids, np.int64), matrix))
        first += len(ids)
        found = found.unionByName(vectors.mapInArrow(search(block, k), _FOUND))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
