"""The near-duplicate stage against brute force at its own limits: five words, 0.8."""

from __future__ import annotations

import corpus_pipeline as pipeline
from tests.llm.test_documents import SPACED, brute_components, fixture_texts, lowered

DIR = "/root/testdata/sf0.001"


def brute_kept(rows):
    """doc_ids that are the least of their component."""
    sets = []
    for i, t in rows:
        w = SPACED.findall(lowered(t or ""))
        sets.append((i, {tuple(w[s : s + 5]) for s in range(max(1, len(w) - 4))} if w else set()))
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            both = len(x & y)
            if None not in (i, j) and both and 100 * both >= 80 * len(x | y):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i for i in parent if root(i) == i}


def test_near_copies_go(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select(*pipeline.COLUMNS)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    narrow = {i for i, _, c in brute_components(rows) if i == c}
    # Two words of 100 differ: linked at 0.8 of five words, and not at 0.9 of three.
    base = [f"v{i}" for i in range(100)]
    near = [(900, " ".join(base)), (901, " ".join([*base[:40], "x", *base[41:80], "y", *base[81:]]))]
    made = fixture_texts() + near
    own = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in made], docs.schema)
    for df, said in ((docs, rows), (own, made)):
        kept = {r.doc_id for r in pipeline.near_duplicates(spark, df, DIR).collect()}
        assert kept == brute_kept(said)
    assert brute_kept(rows) < narrow
    assert brute_kept(near) == {900} and len({c for _, _, c in brute_components(near)}) == 2
