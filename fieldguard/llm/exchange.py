"""Packed shuffles: many (hash, place) entries of a task travel as a few binary rows per bucket."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import SparkSession


def bucket_count(spark: SparkSession, least: int = 32) -> int:
    """Buckets to deal hashes into; follows the shuffle partitions the cluster is set up for."""
    return max(least, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def pack(values: np.ndarray) -> bytes:
    """A rising list of whole numbers, as compressed differences."""
    values = np.asarray(values, np.int64)
    steps = np.diff(values, prepend=0)
    kind = np.uint8 if not len(steps) or (steps.min() >= 0 and steps.max() < 256) else np.int64
    if kind is np.int64 and steps.min() >= 0 and steps.max() < 65536:
        kind = np.uint16
    mark = {np.uint8: b"1", np.uint16: b"2", np.int64: b"8"}[kind]
    return mark + zstandard.ZstdCompressor(level=1).compress(steps.astype(kind).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    kind = {b"1": np.uint8, b"2": np.uint16, b"8": np.int64}[blob[:1]]
    raw = zstandard.ZstdDecompressor().decompress(blob[1:])
    return np.cumsum(np.frombuffer(raw, kind).astype(np.int64))


def cut_bytes(hashes: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each hash."""
    return np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def whole_hashes(blob: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view(np.uint64).ravel()


def by_bucket(buckets: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings buckets together and keeps their entries' order; the cuts between them."""
    kind = np.uint16 if count <= 1 << 16 else np.uint32
    order = np.argsort(buckets.astype(kind), kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(buckets, minlength=count))])
