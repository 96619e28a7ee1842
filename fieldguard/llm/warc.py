"""WARC archives: writing with revisits, and reading by boundary-chain verification.

Writing: pages with equal payloads become one response and revisits. Whether a payload can have an
equal at all is first looked up in a table of ``CELLS`` digest cells (its size is fixed), so that only
pages in shared cells are shuffled. Records are written by Spark's text writer, through whatever
file system the folder is in: the blank lines between records are its line separator.

Reading: Spark's text reader cuts the files at every magic, so a file is read by many tasks. Each
segment after a magic is a candidate record; its header proposes the offset of its successor. A
candidate counts only if the chain of successors from offset 0 of its file reaches it. Chains are
first contracted inside a task's block, then pointers jump over blocks (the reach doubles in every
round), then each block marks what its entry reaches. A magic inside a payload starts a candidate that
no chain reaches; the payload it cut is put together again from its segments.

Defined results: null html is an empty payload; a null page_id is written as an empty id and is never
referred to (its record is a response if no page with an id has the payload); rows repeated with one
page_id and payload are records of one kind. An empty table gives empty archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldguard.llm.words import text_arrays
from fieldguard.session import settle, shared_dir, small_side

# Fixed values of the format.
MAGIC, END = b"WARC/1.1\r\n", b"\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CELLS = 1 << 20
DATE = "1970-01-01T00:00:00Z"

_SEGMENT = (
    "file string, block long, rel long, size long, length long, kind string, page_id string, "
    "refers_to string, digest string, payload_bytes long, made_digest string, whole boolean"
)
_RAW = "file string, block long, rel long, value binary"
_CHAIN = "file string, block long, start long, nxt long, exit long"


def base32_digest(payload: Column) -> Column:
    digits = F.sha1(payload)
    out = []
    for i in range(8):
        value = F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            out.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*out)


def classified(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, digest, bytes, refers_to (null for responses)."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        html.alias("html"),
        base32_digest(F.encode(html, "UTF-8")).alias("digest"),
        F.octet_length(html).cast("long").alias("bytes"),
    ).withColumn("cell", F.pmod(F.xxhash64("digest"), F.lit(CELLS)))
    can_be = rows.where(F.col("bytes") >= least_bytes)
    full = can_be.groupBy("cell").count().where("count > 1").select("cell", F.lit(True).alias("met"))
    # At most CELLS rows of a few bytes.
    flagged = rows.join(F.broadcast(settle(full)), "cell", "left")
    several = F.col("met").isNotNull() & (F.col("bytes") >= least_bytes)
    alone = flagged.where(~several).withColumn("largest", F.lit(None).cast("long"))
    met = flagged.where(several)
    largest = met.groupBy("digest", "bytes").agg(F.max("page_id").alias("largest"))
    met = met.join(largest, ["digest", "bytes"]).select(alone.columns)
    refers = F.when(
        F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")
    )
    return alone.unionByName(met).select(
        "page_id", "url", "html", "digest", "bytes", refers.alias("refers_to")
    )


def record(date: str) -> Column:
    """The text of a record, without the blank lines that end it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.col("bytes").cast("string")),
        F.lit("\r\n"),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")
    return F.concat(
        F.lit(MAGIC.decode()),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.when(url.isNotNull(), line("WARC-Target-URI", url)).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("refers_to"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archives(
    pages: DataFrame, path: str | None = None, least_bytes: int = 0, date: str = DATE
) -> str:
    """Write a record for every page; the folder of the archives."""
    path = path or f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid4().hex}"
    records = classified(pages, least_bytes).select(record(date).alias("value"))
    records.write.option("lineSep", END.decode()).mode("errorifexists").text(path)
    return path


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """Text between magics, with the file and the block of the file whose reader met it."""
    cut = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return cut.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """file, block, offset in what the block's reader met, bytes. A reader meets a block in order."""
    key, rel = None, 0
    for batch in batches:
        data, offsets = text_arrays(batch.column("value"))
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        for i, now in enumerate(zip(files, blocks, strict=True)):
            if now != key:
                key, rel = now, 0
            yield *now, rel, data[offsets[i] : offsets[i + 1]]
            rel += int(offsets[i + 1] - offsets[i]) + len(MAGIC)


def _header(head: bytes) -> dict[bytes, bytes]:
    lines = [x.partition(b":") for x in head.split(b"\r\n")]
    return {name.strip().lower(): value.strip() for name, colon, value in lines if colon}


def _urn(value: bytes | None) -> str | None:
    found = re.fullmatch(rb"<urn:page:(-?[0-9]*)>", value or b"")
    return found[1].decode() if found else None


def _payload(block: bytes) -> tuple[int | None, bytes]:
    """The payload's length by the HTTP header, and the bytes after that header."""
    head, _, body = block.partition(END)
    size = _header(head).get(b"content-length", b"")
    return (int(size) if size.isdigit() else None), body


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task side of reading: a narrow row per segment, with its record's fields if it has a header."""
    names = [x.split()[0] for x in _SEGMENT.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.bool_()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    rows: list[tuple] = []
    for file, block, rel, view in _positions(batches):
        segment = view.tobytes()
        head, colon, rest = segment.partition(END)
        fields = _header(head) if colon else {}
        size = fields.get(b"content-length", b"")
        row = (file, block, rel, len(segment), None, None, None, None, None, None, None, None)
        if size.isdigit() and b"warc-type" in fields:
            length = len(head) + len(END) + int(size)
            whole = len(rest) >= int(size)
            payload_bytes, body = _payload(rest[: int(size)]) if whole else (None, b"")
            kind = fields[b"warc-type"].decode("utf-8", "replace")
            row = (
                file, block, rel, len(segment), length, kind, _urn(fields.get(b"warc-record-id")),
                _urn(fields.get(b"warc-refers-to")),
                fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:"),
                payload_bytes, _digest(body) if whole and kind == "response" else None, whole,
            )
        rows.append(row)
        if len(rows) >= 5000:
            yield made(rows)
            rows = []
    yield made(rows)


def contract(table: pa.Table) -> pa.Table:
    """Within a block: where the chain from each candidate leaves the block."""
    start, nxt = table.column("start").to_numpy(), table.column("nxt").to_numpy()
    leave: dict[int, int] = {}
    for i in np.argsort(-start, kind="stable"):
        leave[int(start[i])] = leave.get(int(nxt[i]), int(nxt[i]))
    return table.select(["file", "block", "start", "nxt"]).append_column(
        "exit", pa.array([leave[int(s)] for s in start], pa.int64())
    )


def follow(table: pa.Table, entries: pa.Table) -> pa.Table:
    """Within a block: the candidates that the chains from its entries reach."""
    nxt = dict(zip(table.column("start").to_pylist(), table.column("nxt").to_pylist(), strict=True))
    reached = set()
    for at in entries.column("entry").to_pylist():
        while at in nxt and at not in reached:
            reached.add(at)
            at = nxt[at]
    name = table.column("file")[:1].to_pylist() * len(reached)
    return pa.table({"file": pa.array(name, pa.string()), "start": pa.array(sorted(reached), pa.int64())})


def reachable(chains: DataFrame) -> DataFrame:
    """file, start of the records on their file's chain from offset 0.

    ``chains`` has file, block, start, nxt for all candidates.
    """
    narrow = chains.select("file", "block", "start", "nxt")
    contracted = settle(narrow.groupBy("file", "block").applyInArrow(contract, _CHAIN))
    jumps = contracted.select("file", "start", F.col("exit").alias("to"))
    reach = settle(contracted.where("start = 0").select("file", "start").distinct())
    count = reach.count()
    while True:
        step = reach.join(jumps, ["file", "start"]).select("file", F.col("to").alias("start"))
        step = step.join(contracted.select("file", "start"), ["file", "start"], "left_semi")
        reach = settle(reach.union(step).distinct())
        now = reach.count()
        if now == count:
            break
        count = now
        far = jumps.select("file", F.col("start").alias("to"), F.col("to").alias("then"))
        jumps = settle(jumps.join(far, ["file", "to"]).select("file", "start", F.col("then").alias("to")))
    entries = contracted.join(reach, ["file", "start"], "left_semi").select(
        F.col("file").alias("entry_file"), F.col("block").alias("entry_block"), F.col("start").alias("entry")
    )
    return (
        contracted.groupBy("file", "block")
        .cogroup(entries.groupBy("entry_file", "entry_block"))
        .applyInArrow(follow, "file string, start long")
    )


def _join_segments(table: pa.Table) -> pa.Table:
    table = table.sort_by("offset")
    record = MAGIC.join(table.column("value").to_pylist())[: table.column("length")[0].as_py()]
    size, payload = _payload(record.partition(END)[2])
    return pa.table(
        {
            "file": table.column("file")[:1],
            "start": table.column("start")[:1],
            "mended_bytes": pa.array([size], pa.int64()),
            "mended": pa.array([_digest(payload)]),
        }
    )


def _reassemble(pieces: DataFrame) -> DataFrame:
    """file, start, mended_bytes, mended (digest) of records whose payload holds a magic."""
    return pieces.groupBy("file", "start").applyInArrow(
        _join_segments, "file string, start long, mended_bytes long, mended string"
    )


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, block, rel, view in _positions(batches):
        yield pa.RecordBatch.from_pydict(
            {"file": pa.array([file]), "block": pa.array([block], pa.int64()), "rel": pa.array([rel], pa.int64()), "value": pa.array([view.tobytes()], pa.binary())}
        )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record on a chain."""
    segments = settle(_segments(spark, path).mapInArrow(parse, _SEGMENT))
    totals = segments.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # A record starts where its magic does; what stands before a file's first magic is no record.
    placed = segments.join(base, ["file", "block"]).withColumn(
        "start", F.col("base") + F.col("rel") - len(MAGIC)
    )
    placed = settle(placed.where("start >= 0"))
    candidates = placed.where("length IS NOT NULL").withColumn(
        "nxt", F.col("start") + len(MAGIC) + F.col("length") + len(END)
    )
    chain = settle(reachable(candidates))
    records = candidates.join(chain, ["file", "start"], "left_semi")
    cut = settle(records.where("NOT whole").select("file", "start", "nxt", "length"))
    if not cut.isEmpty():
        # Only records whose payload holds a magic: their segments lie between start and successor.
        segment = placed.select("file", "block", "rel", F.col("start").alias("offset"))
        inside = cut.join(segment, "file").where("offset >= start AND offset < nxt")
        raw = _segments(spark, path).mapInArrow(_raw, _RAW)
        pieces = raw.join(small_side(inside), ["file", "block", "rel"])
        records = records.join(_reassemble(pieces), ["file", "start"], "left").withColumns(
            {
                "payload_bytes": F.coalesce("payload_bytes", "mended_bytes"),
                "made_digest": F.when(F.col("kind") == "response", F.coalesce("made_digest", "mended")),
            }
        )
    return records.select(
        F.when(F.col("page_id") != "", F.col("page_id").cast("long")).alias("page_id"),
        "payload_bytes",
        F.coalesce("made_digest", "digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.when(F.col("refers_to") != "", F.col("refers_to").cast("long")).alias("refers_to"),
    )
