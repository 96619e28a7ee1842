from __future__ import annotations

import math
import random

import numpy as np
import pytest

from fieldguard.operators import order_stats
from fieldguard.session import settle

KEYS = ["g"]


def brute_cover(values, share):
    values = sorted(values)
    n = len(values)
    if share <= 0:
        return values[0], values[0]
    k = max(1, min(math.ceil(share * n), n))
    if k == 1:
        return values[n // 2], values[n // 2]
    best = None
    for lo, hi in zip(values, values[k - 1 :]):
        width = hi - lo
        width = width if math.isfinite(width) else math.inf
        if best is None or width < best[0]:
            best = (width, lo, hi)
    return best[1], best[2]


def sample(seed):
    rng = random.Random(seed)
    groups = {
        "normal": [rng.gauss(0, 5) for _ in range(400)],
        "coarse": [float(rng.randint(0, 12)) for _ in range(500)],
        # One value holds most rows.
        "hot": [7.0] * 900 + [rng.uniform(0, 50) for _ in range(200)],
        "same": [3.5] * 50,
        "one": [42.0],
        "two": [1.0, 9.0],
        "signed": [rng.choice([-1, 1]) * rng.expovariate(0.1) for _ in range(333)],
    }
    return groups


def counted(spark, groups):
    data = [(g, x) for g, xs in groups.items() for x in xs]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "g string, x double")
    return settle(order_stats.count_values(df, KEYS, "x"))


# Small chunks force many edges; the large one takes the single-chunk way.
@pytest.mark.parametrize("chunk_rows", [3, 64, 1 << 20])
def test_quantiles_match_numpy(spark, chunk_rows):
    groups = sample(5)
    got = order_stats.quantiles(
        counted(spark, groups), KEYS, "x", [0.25, 0.5, 0.75, 1.0], chunk_rows=chunk_rows
    )
    for r in got.collect():
        xs = groups[r["g"]]
        assert r["n"] == len(xs) and r["smallest"] == min(xs) and r["largest"] == max(xs)
        want = np.quantile(xs, [0.25, 0.5, 0.75, 1.0])
        assert [r["q0"], r["q1"], r["q2"], r["q3"]] == pytest.approx(list(want), abs=1e-9)


@pytest.mark.parametrize("chunk_rows", [3, 50, 1 << 20])
@pytest.mark.parametrize("share", [0.0, 0.001, 0.5, 0.95, 1.0])
def test_cover_matches_brute_force(spark, chunk_rows, share):
    groups = sample(9)
    got = order_stats.shortest_cover(
        counted(spark, groups), KEYS, "x", share, chunk_rows=chunk_rows
    ).collect()
    assert {r["g"]: (r["lo"], r["hi"]) for r in got} == {
        g: brute_cover(xs, share) for g, xs in groups.items()
    }
    for r in got:
        inside = sum(r["lo"] <= x <= r["hi"] for x in groups[r["g"]])
        assert share <= 0 or inside >= math.ceil(share * r["n"]) or r["lo"] == r["hi"]


def test_cover_puts_infinite_widths_last(spark):
    groups = {
        "some": [-math.inf, 1.0, 2.0, 5.0, math.inf],
        "all": [-math.inf, -math.inf, math.inf, math.inf],
    }
    got = order_stats.shortest_cover(counted(spark, groups), KEYS, "x", 0.5, chunk_rows=2)
    assert {r["g"]: (r["lo"], r["hi"]) for r in got.collect()} == {
        "some": (1.0, 5.0),
        "all": (-math.inf, -math.inf),
    }


@pytest.mark.parametrize("chunk_rows", [5, 1 << 20])
def test_row_numbers_with_nulls_and_a_hot_group(spark, chunk_rows):
    rng = random.Random(3)
    data = [("hot" if i % 3 else f"g{i % 7}", rng.choice([None, "a", "b", "c"]), i) for i in range(600)]
    df = spark.createDataFrame(data, "g string, s string, i int")
    got = order_stats.row_numbers(df, KEYS, ["s", "i"], chunk_rows=chunk_rows, total="n").collect()
    for g in {r["g"] for r in got}:
        part = sorted((r for r in got if r["g"] == g), key=lambda r: (r["s"] is None, r["s"] or "", r["i"]))
        assert [r["rank"] for r in part] == list(range(1, len(part) + 1))
        assert {r["n"] for r in part} == {len(part)}


def test_chunks_stay_small(spark):
    """With many edges, no window sees a whole hot group."""
    df = settle(spark.range(5000).selectExpr("'hot' as g", "id as x", "1L as _count"))
    plan = order_stats.with_running_total(df, KEYS, ["x"], weight="_count", chunk_rows=100)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window" in line and "sum(_count" in line]
    assert windows and all("_chunk" in line for line in windows)
    assert [r["_before"] for r in plan.orderBy("x").collect()] == list(range(5000))


def test_first_rows_both_ways(spark, monkeypatch):
    df = spark.range(300).selectExpr("id % 2 as g", "-id as x")
    small = {tuple(r) for r in order_stats.first_rows(df, KEYS, ["x"], 4).collect()}
    monkeypatch.setattr(order_stats, "LIMIT_PUSHED", 1)
    large = {tuple(r) for r in order_stats.first_rows(df, KEYS, ["x"], 4, chunk_rows=10).collect()}
    assert small == large and len(small) == 8
    monkeypatch.undo()
    plan = order_stats.first_rows(df, KEYS, ["x"], 4)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("chunk_rows", [4, 1 << 20])
def test_null_keys_are_groups(spark, chunk_rows):
    """Both routes keep rows whose key is NULL, alone and beside other groups."""
    data = [(None if i % 2 else "a", None if i % 3 else i % 5, i) for i in range(60)]
    df = spark.createDataFrame(data, "g string, h int, i int")
    got = order_stats.row_numbers(df, ["g", "h"], ["i"], chunk_rows=chunk_rows, total="n").collect()
    assert len(got) == 60
    for key in {(r["g"], r["h"]) for r in got}:
        part = sorted((r for r in got if (r["g"], r["h"]) == key), key=lambda r: r["i"])
        assert [r["rank"] for r in part] == list(range(1, len(part) + 1))
        assert {r["n"] for r in part} == {len(part)}


@pytest.mark.parametrize("chunk_rows", [4, 1 << 20])
def test_quantiles_of_a_null_group(spark, chunk_rows):
    df = settle(spark.range(41).selectExpr("cast(null as string) as g", "cast(id as double) as x", "1L as _count"))
    row = order_stats.quantiles(df, KEYS, "x", [0.25, 0.5], chunk_rows=chunk_rows).collect()
    assert [tuple(r) for r in row] == [(None, 41, 0.0, 40.0, 10.0, 20.0)]


def test_selection_of_extreme_values(spark):
    """Subnormals, infinities, both zeros, neighbours in the last bit and repeats, counted more than once."""
    rng = random.Random(8)
    wide = [rng.choice([-1, 1]) * 2.0 ** rng.uniform(-1070, 1020) for _ in range(300)] + [0.0, -0.0, 5e-324, -5e-324]
    close = [1.0 + i * 2**-52 for i in range(200)]
    groups = {"wide": wide, "close": close, "ends": [-math.inf] * 3 + [1e308, -1e308] * 5 + [math.inf] * 2, None: [2.0, 3.0] * 40}
    data = [(g, x, n) for g, xs in groups.items() for x in xs for n in (1, 2)]
    counts = settle(spark.createDataFrame(data, "g string, x double, _count bigint"))
    probabilities = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r["g"]: r for r in order_stats.quantiles(counts, KEYS, "x", probabilities, chunk_rows=2).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        ranked = sorted(xs * 3)
        for i, q in enumerate(probabilities):
            place = (len(ranked) - 1) * q
            low, part = math.floor(place), place - math.floor(place)
            a, b = ranked[low], ranked[min(low + 1, len(ranked) - 1)]
            want = a if part == 0 else a + (b - a) * part
            assert got[g][f"q{i}"] == want or math.isnan(got[g][f"q{i}"]) and math.isnan(want), (g, q)


def test_selection_sorts_nothing_whole(spark):
    """Large tables are counted by digits: no range exchange, and windows only over buckets and what is left."""
    rng = random.Random(9)
    counts = settle(spark.createDataFrame([("hot", rng.gauss(0, 9), 1) for _ in range(4000)], "g string, x double, _count bigint"))
    out = order_stats.quantiles(counts, KEYS, "x", [0.25, 0.75], chunk_rows=200)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan
    windows = [line for line in plan.splitlines() if "Window" in line and "sum(" in line]
    assert all("_t" in line for line in windows)
    xs = sorted(r["x"] for r in counts.collect())
    assert np.allclose(list(out.first())[-2:], np.quantile(xs, [0.25, 0.75]), rtol=0, atol=1e-12)
