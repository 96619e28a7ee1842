"""The Jaccard join over sets on both sides of a change of the bitmap's width, against brute force."""

from __future__ import annotations

import random

import numpy as np

from fieldguard.llm import jaccard
from tests.llm.test_documents import brute_components


def test_folded_widths_link(spark):
    draw = random.Random(5)
    words = [f"w{draw.randrange(10**6)}" for _ in range(9000)]
    passage = words[-300:]
    rows = [
        (1, " ".join(words[:2100])),
        (2, " ".join(words[:1950])),  # 0.93 of the first, narrower bitmap
        (3, " ".join(words[:1850])),  # linked with the second only
        (4, " ".join([*words[2200:4400], *passage])),  # shares a passage with the next, no more
        (5, " ".join([*words[4400:6600], *passage])),
        (6, " ".join(words[:8200])),  # 32 times the narrowest cells
        (7, " ".join([*words[:3000], "x", *words[3001:7990]])),
        (8, None),
        (9, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_components(docs).collect()}
    expected = {tuple(r) for r in brute_components(rows)}
    assert made == expected
    component = {i: c for i, _, c in expected}
    assert component[2] == component[3] == 1 and component[7] == 6 and component[5] == 5


def test_bitmaps_never_count_more_than_the_sets_differ(spark):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 63, 9000).astype(np.uint64)
    parts = [base[:1900], base[50:2060], base[:1700], base[100:8300], base[:7900], base[:0]]
    doc = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    n = np.array([len(x) for x in parts])
    bits = jaccard._bitmaps(doc, np.concatenate(parts), n).to_pylist()
    assert [len(x) for x in bits] == [8, 32, 8, 128, 32, 8]
    pairs = [(i, j) for i in range(6) for j in range(6) if max(len(bits[i]), len(bits[j])) <= 4 * min(len(bits[i]), len(bits[j]))]
    df = spark.createDataFrame([(i, j, bits[i], bits[j]) for i, j in pairs], "i int, j int, x array<long>, y array<long>")
    for r in df.select("i", "j", jaccard._differ(df.x, df.y).alias("d")).collect():
        apart = len(set(parts[r.i].tolist()) ^ set(parts[r.j].tolist()))
        assert 0 <= r.d <= apart and r.d % 2 == apart % 2
        assert (r.d == 0) == (apart == 0)
