"""The near-duplicate stage's limits on documents that share a passage and no more."""

from __future__ import annotations

import random

import numpy as np

from fieldguard.llm import jaccard


def test_a_shared_passage_makes_no_pairs(spark, monkeypatch):
    draw = random.Random(8)
    plain = [f"p{i}" for i in range(60)]
    passage = [f"q{i}" for i in range(60)]  # its words are rarer than all others
    texts = [[*draw.choices(plain, k=700), *passage, *draw.choices(plain, k=700)] for _ in range(40)]
    near = list(texts[3])
    for i in range(0, len(near), 100):  # 0.9 of the shingles are left
        near[i] = "x"
    rows = [(i, " ".join(t)) for i, t in enumerate([*texts, near, passage])]
    rows += [(50, " ".join(passage[:-1])), (51, None), (None, rows[0][1])]
    seen, verified = [], jaccard.verified

    def counting(pairs, *rest):
        seen.extend(map(tuple, pairs.collect()))
        return verified(pairs, *rest)

    monkeypatch.setattr(jaccard, "verified", counting)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = {r.doc_id: r.component_id for r in jaccard.link_components(docs, 5, 80).collect()}
    assert made == {i: {40: 3, 50: 41}.get(i, i) for i, _ in rows}
    assert {tuple(sorted(x)) for x in seen} == {(3, 40), (41, 50)}


def test_narrow_bitmaps_serve_fewer_elements_at_lower_similarity():
    assert jaccard.served(90) == jaccard.SERVED and jaccard.served(100) >= jaccard.SERVED
    hashes = np.random.default_rng(4).integers(0, 1 << 63, 2800).astype(np.uint64)
    doc, n = np.repeat([0, 1], 1400), np.array([1400, 1400])
    one, two = (
        np.unpackbits(np.array(x, np.int64).view(np.uint8))
        for x in jaccard._bitmaps(doc, hashes, n, jaccard.served(80)).to_pylist()
    )
    # Sets that share nothing differ in more cells than a similarity of 0.8 allows.
    assert np.count_nonzero(one != two) > 2 * 1400 * 20 / 180
