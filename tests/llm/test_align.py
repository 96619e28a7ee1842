"""Alignment of two tokenizers against walking every pair of tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fieldguard.llm import align, queries

FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
TEXTS = [
    "Plain words, as they come.", "plain words, as they come.", "naïve Straße — 漢字かな 🙂🙂 ﬁne", "", None, " ", "  two  blanks ",
    "tabs\tand\nlines\r\n\r\nend\n", "a", "<|endoftext|> <s> </s> <unk> <0x41>", "low▁bar", "aaaaaaaaaaaaaaaaaaaaaaaa",
    "x" * 40_000, "1234567890 3.14159 0x1F", "don't we'll I'D", "é é ​﻿ ", "\x00\x01nul", "Plain words, as they come.",
    "ａｂｃ １２３", " ".join(f"mot{i} żółć" for i in range(3000)),
]


@pytest.fixture(scope="module")
def paths():
    return [queries.vocabulary(f) for f in FILES]


@pytest.fixture(scope="module")
def pair(paths):
    return align.Pair(open(paths[0], encoding="utf-8").read(), open(paths[1], "rb").read())


def tokens(pair, text):
    """Both sides as (id, bytes), by the libraries alone; none if either loses a byte."""
    from tokenizers.decoders import ByteLevel  # noqa: F401 - the vocabulary's own alphabet

    if not text:
        return [], []
    letters = align.byte_alphabet()
    a = [(i, bytes(letters[c] for c in pair.a.id_to_token(i))) for i in pair.a.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in pair.b.encode(text):
        piece = pair.b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if pair.b.is_byte(i) else piece.replace("▁", " ").encode()))
    said = (" " + text).encode()
    whole = b"".join(x for _, x in a) == said == b"".join(x for _, x in b)
    return (a, b) if whole else ([], [])


def spans(side):
    at, out = 0, []
    for i, x in side:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(pair, rows):
    linked, count = [], Counter()
    for doc, text in rows:
        a, b = map(spans, tokens(pair, text))
        links, low = [], 0
        for i, s, e in a:
            while low < len(b) and b[low][2] <= s:
                low += 1
            k = low
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, last = [], 0
        side = [defaultdict(list), defaultdict(list)]
        for which, xs in enumerate((a, b)):
            g = 0
            for i, _, e in xs:
                while e > ends[g]:
                    g += 1
                side[which][g].append(str(i))
        groups = [",".join(side[0][g]) + "|" + ",".join(side[1][g]) for g in range(len(ends))]
        linked.append((doc, len(a), len(b), groups, links))
        count.update(links)
        del last
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [
        (
            doc, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for doc, n_a, n_b, groups, links in linked
    ]


@pytest.mark.parametrize("piece", [align.PIECE, 40])
def test_link_statistics(spark, pair, paths, piece, monkeypatch):
    monkeypatch.setattr(align, "PIECE", piece)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "again"), (0, TEXTS[0]), (0, TEXTS[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.withColumn("n_a", F.lit("x")).withColumn("_piece", F.lit(1)).withColumn("pair", F.lit(None))
    got = [tuple(r) for r in align.link_statistics(df, *paths).collect()]
    assert sorted(got, key=str) == sorted(brute(pair, rows), key=str)
    assert align.link_statistics(df.limit(0), *paths).collect() == []


def test_runs_is_the_common_ends():
    rnd = random.Random(5)
    for _ in range(400):
        size = rnd.randint(0, 60)
        keep = rnd.choice([0.1, 0.5, 0.9, 0.99])
        ends = [sorted({size, *(i for i in range(1, size) if rnd.random() < keep)} - {0}) for _ in range(2)]
        stretches, cuts, links = align.runs(*ends)
        i_ends = sorted([i + k + 1 for i, _, n in zip(*stretches) for k in range(n)] + cuts[0])
        j_ends = sorted([j + k + 1 for _, j, n in zip(*stretches) for k in range(n)] + cuts[1])
        common = sorted(set(ends[0]) & set(ends[1]))
        assert [ends[0][i - 1] for i in i_ends] == common == [ends[1][j - 1] for j in j_ends]
        spans = [list(zip([0, *e], e)) for e in ends]
        want = [(i, j) for i, (a, b) in enumerate(spans[0]) for j, (c, d) in enumerate(spans[1]) if a < d and c < b]
        ones = [(i + k, j + k) for i, j, n in zip(*stretches) for k in range(n)]
        assert sorted(ones + list(zip(*links))) == want
        assert all(s1 + n1 != s2 or j1 + n1 != j2 for (s1, j1, n1), (s2, j2, _) in zip(zip(*stretches), list(zip(*stretches))[1:]))


def test_align_gives_tokens_and_groups(spark, pair, paths):
    rows = list(enumerate(TEXTS))
    df = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    for r in align.align(df, *paths).collect():
        a, b = tokens(pair, TEXTS[r.doc_id])
        assert r.a_ids == [i for i, _ in a] and r.b_ids == [i for i, _ in b]
        cut_a, cut_b = [e for *_, e in spans(a)], [e for *_, e in spans(b)]
        common = sorted(set(cut_a) & set(cut_b))
        assert [cut_a[i - 1] for i in r.a_ends] == common == [cut_b[j - 1] for j in r.b_ends]


def test_query_is_brute_force(spark, pair):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.QUERIES["op11_align"](spark, d).collect()]
    assert sorted(got) == sorted(brute(pair, rows))
