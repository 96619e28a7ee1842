"""Leaves of documents of unknown shape, as selectors."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(value: object) -> str | None:
    """JSON spelling of a leaf; strings as they are, null as None."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (list, dict)):
        return json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    return str(value)


def _quote(value: object) -> str:
    text = "null" if value is None else _text(value)
    return text.replace("\\", "\\\\").replace(">", "\\>")


# Reports of a collection share most of their selectors.
@lru_cache(maxsize=1 << 14)
def _below(path: str, key: str) -> str:
    return f"{path}.<{_quote(key)}>"


@lru_cache(maxsize=1 << 14)
def _member(path: str, key: str, value: object) -> str:
    return f"{path}.[<{_quote(key)}>=<{_quote(value)}>]"


def leaves(document: object) -> Iterator[tuple[str, str | None]]:
    """(selector, text) of every leaf, in document order; a selector met again is skipped.

    Scalars and lists without objects are leaves. Objects inside lists are told apart by their
    first key and its value; other members of such lists are passed over.
    """
    seen: set[str] = set()
    todo: list[tuple[str, object]] = [("", document)]
    while todo:
        path, node = todo.pop()
        if isinstance(node, dict):
            children = [(_below(path, k), v) for k, v in node.items()]
        elif isinstance(node, list) and any(isinstance(item, dict) for item in node):
            children = []
            for item in node:
                if isinstance(item, dict) and item:
                    key, value = next(iter(item.items()))
                    # Only texts are looked up: 1 equals True in Python, but not in JSON.
                    member = _member if isinstance(value, str) else _member.__wrapped__
                    children.append((member(path, key, value), item))
        else:
            if path and path not in seen:
                seen.add(path)
                yield path, _text(node)
            continue
        todo.extend(reversed(children))


# Leaves per batch handed back; keeps memory flat however wide the documents are.
BATCH_LEAVES = 50_000


def _flatten_batches(
    batches: Iterator[pa.RecordBatch], keys: list[str], schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raws = batch.column("raw")
        origin: list[int] = []
        cells: list[tuple[int, str, str | None]] = []
        for row in range(batch.num_rows):
            try:
                document = json.loads(raws[row].as_py())
            except (TypeError, ValueError, RecursionError):
                continue
            found = [(place, *leaf) for place, leaf in enumerate(leaves(document))]
            cells += found
            origin += [row] * len(found)
            if len(cells) >= BATCH_LEAVES:
                yield _as_batch(batch, keys, schema, origin, cells)
                origin, cells = [], []
        yield _as_batch(batch, keys, schema, origin, cells)


def _as_batch(
    batch: pa.RecordBatch,
    keys: list[str],
    schema: pa.Schema,
    origin: list[int],
    cells: list[tuple[int, str, str | None]],
) -> pa.RecordBatch:
    picked = pa.array(origin, pa.int64())
    columns = [batch.column(k).take(picked) for k in keys]
    columns += [pa.array([cell[i] for cell in cells], schema.field(len(keys) + i).type) for i in range(3)]
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) for c, f in zip(columns, schema)], schema=schema
    )


def flatten_any(
    reports: DataFrame, keys: tuple[str, ...] = ("model", "taskid", "episode_id")
) -> DataFrame:
    """(keys, pos, field, value) of every leaf of every report; unreadable reports give nothing.

    Discovery needs the document order of keys, which Spark's own JSON types do not keep, so this
    walks documents in Python, one Arrow batch at a time. It is meant for samples (one report per
    task): values of known fields come from ``extract_values`` instead.
    """
    narrow = reports.select(*keys, "raw")
    schema = T.StructType([reports.schema[k] for k in keys])
    schema = schema.add("pos", T.IntegerType()).add("field", T.StringType())
    schema = schema.add("value", T.StringType())
    arrow = pa.schema(
        [(k, _arrow_type(reports.schema[k].dataType)) for k in keys]
        + [("pos", pa.int32()), ("field", pa.string()), ("value", pa.string())]
    )
    return narrow.mapInArrow(partial(_flatten_batches, keys=list(keys), schema=arrow), schema)


def _count_batches(
    batches: Iterator[pa.RecordBatch], keys: list[str], schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple, int] = {}

    def counted() -> pa.RecordBatch:
        columns = [*zip(*counts, strict=True)] or [()] * (len(schema) - 1)
        arrays = [pa.array(c, f.type) for c, f in zip([*columns, counts.values()], schema, strict=True)]
        counts.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for batch in batches:
        names = zip(*[batch.column(k).to_pylist() for k in keys], strict=True) if keys else repeat(())
        for raw, name in zip(batch.column("raw").to_pylist(), names):
            try:
                document = json.loads(raw)
            except (TypeError, ValueError, RecursionError):
                continue
            for leaf in leaves(document):
                row = (*name, *leaf)
                counts[row] = counts.get(row, 0) + 1
            if len(counts) >= BATCH_LEAVES:
                yield counted()
    yield counted()


def count_leaves(reports: DataFrame, keys: tuple[str, ...] = ("model",)) -> DataFrame:
    """(keys, field, value, n): how often each leaf of ``flatten_any`` occurs.

    Tasks count what they walk, at most ``BATCH_LEAVES`` different leaves at a time; only counts leave Python.
    """
    narrow = reports.select(*keys, "raw")
    schema = T.StructType([reports.schema[k] for k in keys])
    schema = schema.add("field", T.StringType()).add("value", T.StringType()).add("n", T.LongType())
    arrow = pa.schema(
        [(k, _arrow_type(reports.schema[k].dataType)) for k in keys]
        + [("field", pa.string()), ("value", pa.string()), ("n", pa.int64())]
    )
    parts = narrow.mapInArrow(partial(_count_batches, keys=list(keys), schema=arrow), schema)
    return parts.groupBy(*keys, "field", "value").agg(F.sum("n").alias("n"))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    known = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    return known[kind.simpleString()]
