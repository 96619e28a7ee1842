"""Archives, vectors, dialogues and graphs against brute force."""

from __future__ import annotations

import base64
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from fieldguard.llm import chat, graph, topk, warc

MAGIC = "WARC/1.1\r\n"
INNER = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:777>\r\nContent-Length: 30\r\n\r\nHTTP/1.1 200 OK\r\n\r\n0123456789\r\n\r\n"


@pytest.mark.parametrize("split", ["1500", "128m"])
def test_archives(spark, split):
    """Records, magic and whole records inside payloads, with many readers per file and with one."""
    bodies = ["<p>a</p>", "", None, "x" * 5000, INNER, INNER * 2 + "z", MAGIC, MAGIC * 400, "<p>a</p>", "\r\n\r\n", "é" * 900, "e", ""]
    rows = [(i, f"http://x/é\r\n{i}", t) for i, t in enumerate(bodies + [f"page {i} " * 50 for i in range(60)])]
    rows += [(None, "u", "x" * 5000), (5, "dup", INNER * 2 + "z"), (99, None, "url")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).withColumn("digest", F.lit(1))
    top: dict = {}
    for i, _, t in rows:
        if i is not None:
            top[t or ""] = max(top.get(t or "", -1), i)
    want = []
    for i, _, t in rows:
        body = (t or "").encode()
        first = i == top.get(t or "", i)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((i, len(body), digest, "response" if first else "revisit", None if first else top[t or ""]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = list(map(tuple, warc.read_archives(spark, warc.write_archives(df)).collect()))
        none = warc.read_archives(spark, warc.write_archives(df.limit(0))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got, key=str) == sorted(want, key=str)
    assert none == []


@pytest.mark.parametrize("block_bytes", [topk.BLOCK_BYTES, 1])
def test_top_k(spark, block_bytes):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([0.5, -0.5, rnd.gauss(0, 0.3)]) for _ in range(8)]) for i in range(230)]
    rows += [(300, None), (301, [None] * 8), (302, [math.nan] * 8), (303, [math.inf] * 8), (304, []), (305, [1.0, 2.0]), (None, [1.0] * 8), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).withColumn("score", F.lit(0))
    single = {r[0]: r[1] for r in df.where("vec_id IS NOT NULL").select("vec_id", "embedding").collect()}
    usable = [
        (i, [math.floor(256 * x) for x in single[i]]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    want = []
    for q, a in usable:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in usable if i != q)
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(df.where("false"), df.where("false")).collect() == []


def test_perspectives(spark):
    rows = [(1, t, r, f"<|im_end|> {t}") for t, r in enumerate(["system", "ann", "bob", "cy", "ann"])]
    rows += [(2, t, "user" if t % 2 else "assistant", None if t == 3 else "w" * (t % 7)) for t in range(600)]
    rows += [(3, 0, "system", "alone"), (None, 0, "ann", "x"), (None, None, None, "y"), (4, 1, "ann", "same"), (4, 1, "ann", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("name", F.lit(1))
    got = chat.perspectives(df).collect()
    examples: dict = {}
    for r in got:
        examples.setdefault((r.conv_id, r.assistant), []).append(r)
    assert set(examples) == {(1, "ann"), (1, "bob"), (1, "cy"), (2, "user"), (2, "assistant"), (None, "ann"), (None, "unknown"), (4, "ann")}
    for (conv, who), turns in examples.items():
        turns.sort(key=lambda r: r.nth)
        said = sorted(
            [(t is not None, t or 0, r or "unknown", (x or "").replace("<|", "< |")) for c, t, r, x in rows if c == conv]
        )
        assert [r.nth for r in turns] == list(range(len(said)))
        at = 0
        for r, (_, _, role, text) in zip(turns, said, strict=True):
            shown = "system" if role == "system" else "assistant" if role == who else f"user name={role}"
            assert r.message == f"<|im_start|>{shown}\n{text}<|im_end|>\n"
            assert (r.start, r.end) == (at, at + len(r.message))
            masked = r.message[r.mask_start - at : r.mask_end - at] if r.mask_start is not None else None
            assert masked == (f"{text}<|im_end|>" if role == who else None)
            at = r.end
    assert chat.perspectives(df.where("false")).collect() == []


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(30)]
    links += [(200, x) for x in range(201, 260)] + [(5, 5)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = graph.components(spark.createDataFrame(links, "a long, b long"))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert sorted(map(tuple, got.collect())) == sorted((x, root(x)) for x in linked)
