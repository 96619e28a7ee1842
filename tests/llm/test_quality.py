"""The factorisation machine: its identity, its gradient, edge cases, held-out rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fieldguard.llm import quality, queries

TEXTS = ["A few plain words.", "", None, "x", "NO!! NO!! NO!! 12", "é" * 500, "a b a b\na b\na b\n", " \n ", "w " * 30_000]


def batch(texts, stated=None):
    stated = [len(t or "") for t in texts] if stated is None else stated
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(stated, pa.int64())], names=["text", "n_chars"])


def some_machine(seed=1):
    rnd = np.random.default_rng(seed)
    blank = quality.Machine.blank(rnd.normal(0, 1, quality.WIDTH), np.full(quality.WIDTH, 2.0), 0.3)
    return blank.moved(rnd.normal(0, 0.3, len(blank.flat())))


def test_linear_time_is_all_pairs():
    m, x = some_machine(), quality.features(batch(TEXTS[:8]))
    row, place, value = m.inputs(x)
    made, _ = m.sums(row, place, value, 8)
    for r in range(8):
        p, v = place[row == r], value[row == r]
        want = m.bias + (m.weights[p] * v).sum()
        for i in range(len(p)):
            for j in range(i):
                want += m.vectors[p[i]] @ m.vectors[p[j]] * v[i] * v[j]
        assert abs(want - made[r]) < 1e-8


def test_gradient_is_the_slope():
    m, x, label = some_machine(2), quality.features(batch(TEXTS[:7])), np.array([1, 0, 1, 0, 0, 1, 1.0])

    def loss(flat):
        p = m.moved(flat).scores(x)
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).sum()

    flat, slope = m.flat(), m.gradient(x, label)
    used = np.flatnonzero(slope)
    assert len(used) > 50
    for i in [0, *used[:: max(1, len(used) // 60)]]:
        step = np.zeros_like(flat)
        step[i] = 1e-5
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-5 - slope[i]) < 1e-4


def test_statistics():
    x = quality.features(batch(["NO!! no!! aé1\n\nno!!\nno!!\n", "", "ab"], [None, -3, 8]))
    s = {name: x.statistics[:, i] for i, name in enumerate(quality._STATISTICS)}
    assert np.allclose(s["words"], np.log1p([5, 0, 1]))
    assert np.allclose(s["distinct words"], [2 / 5, 0, 1]) and np.allclose(s["top word"], [4 / 5, 0, 1])
    assert np.allclose(s["same word again"], [2 / 5, 0, 0])
    assert np.allclose(s["words ending in a symbol"], [4 / 5, 0, 0])
    assert np.allclose(s["repeated lines"], [1 / 3, 0, 0])
    assert np.allclose(s["stated length apart"], [0, 0, np.log(9 / 3)])
    assert np.all(np.isfinite(quality.features(batch(TEXTS)).statistics))
    lengths = np.bincount(x.row, x.value**2, minlength=3)
    assert np.allclose(lengths, [1, 0, 1])


def test_edge_cases(spark):
    rows = [(i, t, None, "l") for i, t in enumerate(TEXTS * 8)] + [(None, "null id", -1, "l"), (0, TEXTS[0], 18, "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, score string").withColumn("_score", F.lit("x"))
    marks = [(i, int(len(t or "") % 2), 0) for i, t in enumerate(TEXTS * 8)] + [(0, None, 0), (0, 0, 0), (None, 1, 1), (999, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = quality.score_documents(df, labels, rounds=4).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    assert quality.score_documents(df.limit(0), labels, rounds=2).collect() == []
    assert {r.score for r in quality.score_documents(df, labels.limit(0), rounds=2).collect()} == {0.5}
    kept = quality.score(df, some_machine())
    assert kept.columns == ["doc_id", "text", "n_chars", "score", "_score"]


def test_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality").collect()}
    rows = queries.QUERIES["op13_quality"](spark, d).collect()
    known = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = [x for x in known if x[0] == 1], [x for x in known if x[0] == 0]
    print(len(good), len(bad), sum(p for *_, p in good) / len(good), 1 - sum(p for *_, p in bad) / len(bad))
    assert sum(p for *_, p in good) / len(good) > 0.97
    assert 1 - sum(p for *_, p in bad) / len(bad) > 0.9
