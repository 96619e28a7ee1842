from __future__ import annotations

import itertools
import math

import pytest
from pyspark.sql import functions as F

from fieldguard.functions import intervals as iv
from fieldguard.functions.numeric import bool_number, has_content, parse_number, present
from fieldguard.operators import declare, learn
from fieldguard.operators.learn import LearnParams, TextRule
from tests.conftest import rows

PLAIN = dict(
    sign_clamp=False, post_expand_sign_clamp=False, clamp_to_observed=False, region_adjust=False,
    expand_pct=0.0, round_decimals=None,
)


def test_number_texts(spark):
    cases = {
        "1": 1.0, " 2.5 ": 2.5, "-3e2": -300.0, "+4": 4.0, ".5": 0.5, "5.": 5.0, "inf": math.inf,
        "-Infinity": -math.inf, "1_000": None, "0x10": None, "0x1p3": None, "1d": None, "1f": None,
        "1e5D": None, "nan": None, "NaN": None, "": None, "abc": None, "true": None, None: None,
        "N/A": None, "1,5": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r["v"]: r["x"] for r in df.select("v", parse_number(F.col("v")).alias("x")).collect()}
    assert got == cases


def test_missing_texts(spark):
    df = spark.createDataFrame([(v,) for v in ["", "NA", " ", "x", "nan", "Nan", "None", None]], "v string")
    got = {
        r["v"]: (r["p"], r["c"])
        for r in df.select("v", present(F.col("v")).alias("p"), has_content(F.col("v")).alias("c")).collect()
    }
    assert got == {
        "": (None, False), "NA": (None, False), " ": (" ", False), "x": ("x", True),
        "nan": (None, False), "Nan": ("Nan", False), "None": (None, False), None: (None, False),
    }
    one = df.select(bool_number(F.lit("TRUE")).alias("t"), bool_number(F.lit("no")).alias("n")).first()
    assert (one["t"], one["n"]) == (1.0, None)


def apply(spark, fn, *pairs):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "lo double, hi double")
    lo, hi = fn(F.col("lo"), F.col("hi"))
    return [tuple(r) for r in df.select(lo.alias("a"), hi.alias("b")).collect()]


def test_widen(spark):
    assert apply(spark, lambda a, b: iv.widen(a, b, 0.5), (0, 2), (3, 3), (0, 0)) == [
        (-1.0, 3.0), (1.5, 4.5), (-0.5, 0.5),
    ]
    # Shrinking by more than half the width crosses over: both ends meet midway.
    assert apply(spark, lambda a, b: iv.widen(a, b, -0.75), (0, 2)) == [(1.0, 1.0)]
    assert apply(spark, lambda a, b: iv.widen(a, b, 0.0), (0, 2)) == [(0.0, 2.0)]
    assert apply(spark, lambda a, b: iv.widen(a, b, math.nan), (0, 2)) == [(0.0, 2.0)]
    (lo, hi), = apply(spark, lambda a, b: iv.widen(a, b, 1.0), (-math.inf, 1))
    assert lo == -math.inf and hi == math.inf


def test_scale_about_centre(spark):
    for factor, want in ((2.0, (-1.0, 3.0)), (1.0, (0.0, 2.0)), (0.0, (0.0, 2.0)), (-2.0, (0.0, 2.0)), (math.inf, (0.0, 2.0))):
        assert apply(spark, lambda a, b: iv.scale_about_centre(a, b, factor), (0, 2)) == [want]
    assert apply(spark, lambda a, b: iv.scale_about_centre(a, b, 2.0), (4, 4)) == [(4.0, 4.0)]


def test_sign_stages(spark):
    def sign(smallest, largest):
        return lambda a, b: iv.pin_to_sign(a, b, F.lit(smallest), F.lit(largest))

    assert apply(spark, sign(0.5, 9.0), (2, 3)) == [(0.5, 3.0)]
    assert apply(spark, sign(-9.0, -1.0), (-3, -2)) == [(-3.0, -1.0)]
    assert apply(spark, sign(-1.0, 1.0), (-3, 2)) == [(-3.0, 2.0)]
    assert apply(spark, sign(0.0, 0.0), (0, 0)) == [(0.0, 0.0)]
    keep = lambda a, b: iv.keep_sign(a, b, F.lit(0.0), F.lit(5.0))
    assert apply(spark, keep, (-2, 7), (-4, -3)) == [(0.0, 7.0), (0.0, 0.0)]


def values(spark, data):
    return spark.createDataFrame(
        [("m", f"e{i}", f, v) for f, vs in data.items() for i, v in enumerate(vs)],
        "model string, episode_id string, field string, value string",
    )


def test_kinds_of_fields(spark):
    df = values(
        spark,
        {
            "numbers": ["1", "2", "NA", None, "x"],
            "texts": ["a", "b"],
            "gaps": [None, "", "nan"],
            "bools": ["true", "false", None, "true"],
            "bools+number": ["true", "5", "6"],
            "bools+text": ["true", "maybe"],
            "single": ["4"],
            "forced": ["1", "2"],
        },
    )
    p = LearnParams(**PLAIN, cover_pct=1.0, non_numeric_rules=[TextRule(["FORCE"])])
    got = {r["field"]: (r["n"], r["lo"], r["hi"], r["is_bool"]) for r in learn.initial_ranges(df, p).collect()}
    assert got == {
        "numbers": (2, 1.0, 2.0, False),
        "texts": (0, None, None, False),
        "gaps": (0, None, None, False),
        "bools": (3, 0.0, 1.0, True),
        "bools+number": (2, 5.0, 6.0, False),
        "bools+text": (0, None, None, False),
        "single": (1, 4.0, 4.0, False),
        "forced": (0, None, None, False),
    }
    done = {r["field"]: r["is_non_numeric"] for r in learn.learn_ranges(df, p).collect()}
    assert done["texts"] and done["gaps"] and done["forced"] and not done["bools"]


@pytest.mark.parametrize("chunk_rows", [4, 1 << 20])
def test_iqr_and_mad(spark, chunk_rows):
    xs = [1.0, 2.0, 2.0, 3.0, 4.0, 7.0, 11.0, 12.5, 30.0]
    df = values(spark, {"a": [str(x) for x in xs], "flat": ["5"] * 6 + ["9"], "few": ["1", "8"]})
    base = dict(PLAIN, min_valid_count=3, chunk_rows=chunk_rows)
    iqr = {r["field"]: (r["lo"], r["hi"]) for r in learn.initial_ranges(df, LearnParams(method="iqr", iqr_k=1.5, **base)).collect()}
    assert iqr["a"] == pytest.approx((2 - 1.5 * 9, 11 + 1.5 * 9))
    assert iqr["flat"] == (5.0, 9.0) and iqr["few"] == (1.0, 8.0)
    mad = {r["field"]: (r["lo"], r["hi"]) for r in learn.initial_ranges(df, LearnParams(method="mad", mad_z=3.0, **base)).collect()}
    # median 4; distances 3 2 2 1 0 3 7 8.5 26 -> median 3
    assert mad["a"] == pytest.approx((4 - 3 * 1.4826 * 3, 4 + 3 * 1.4826 * 3))
    assert mad["flat"] == (5.0, 9.0)


def test_bound_rules(spark):
    rules = [
        iv.BoundRule(["fps"], min_lo=20.0, max_hi=30.0),
        iv.BoundRule(["color", "fps"], max_hi=25.0),
        iv.BoundRule(["fps"], models=["Fast"], min_lo=50.0, max_lo=50.0, min_hi=70.0, max_hi=70.0),
        iv.BoundRule(["FPS", "extra"], models=["fast"], max_hi=60.0),
    ]

    def run(model, name, lo, hi, **kw):
        df = spark.createDataFrame([(model, name, lo, hi)], "m string, f string, lo double, hi double")
        a, b = iv.limit_by_rules(F.col("lo"), F.col("hi"), F.col("m"), F.col("f"), rules, **kw)
        return tuple(df.select(a.alias("a"), b.alias("b")).first())

    assert run("slow", "color fps", 1.0, 99.0) == (20.0, 25.0)
    assert run("slow", "color fps", 1.0, 99.0, apply_all=False) == (20.0, 30.0)
    # Rules for the model switch general rules off.
    assert run("FAST", "color fps", 1.0, 99.0) == (50.0, 70.0)
    assert run("fast", "fps extra", 1.0, 99.0) == (50.0, 60.0)
    assert run("FAST", "color fps", 1.0, 99.0, fold_model_case=False) == (20.0, 25.0)
    assert run("slow", "FPS", 1.0, 99.0, fold_case=False) == (1.0, 99.0)
    # A lower bound pushed above the upper one takes it along.
    assert run("slow", "fps", 40.0, 45.0) == (40.0, 40.0)


def test_stage_orders(spark):
    for order in itertools.permutations(learn.STAGES):
        assert learn.check_stages(order) == order
    for bad in (("sign",), ("sign", "sign", "expand", "field"), learn.STAGES + ("sign",)):
        with pytest.raises(ValueError):
            learn.check_stages(bad)
    df = values(spark, {"a": ["1", "2", "3", "10"]})
    base = dict(PLAIN, cover_pct=1.0, expand_pct=1.0, clamp_to_observed=False, sign_clamp=True)
    first = learn.learn_ranges(df, LearnParams(**{**base, "stages": ("sign", "expand", "region_adjust", "field")})).first()
    last = learn.learn_ranges(df, LearnParams(**{**base, "stages": ("expand", "sign", "region_adjust", "field")})).first()
    assert (first["lo"], first["hi"]) == (-8.0, 19.0)
    assert (last["lo"], last["hi"]) == (1.0, 19.0)


def test_bad_parameters(spark):
    df = values(spark, {"a": ["1"]})
    with pytest.raises(ValueError):
        learn.initial_ranges(df, LearnParams(method="guess"))
    with pytest.raises(ValueError):
        learn.initial_ranges(df, LearnParams(cover_pct=math.nan))
    assert learn.region_multiplier({"north": 2}, "north") == 2.0
    assert learn.region_multiplier({"north": 2}, "south") == 1.0


def test_declared_rules(spark):
    good = {"contains": ["a"], "range": [0, 1]}
    bad = [
        {"contains": ["a"], "range": [0, 1], "models": ["m"]},
        {"range": [0, 1]},
        {"contains": ["a"]},
        {"contains": ["a"], "range": [1]},
        {"contains": ["a"], "range": [None, 1]},
        {"contains": ["a"], "range": ["x", 1]},
        {"contains": ["a"], "range": [0, math.inf]},
        {"contains": ["a"], "range": [2, 1]},
        {"contains": ["a"], "range": [0, 1], "min_lo": 0},
    ]
    assert declare.rule_problems([good], []) == []
    assert {at for _, at, _ in declare.rule_problems(bad, [])} == set(range(len(bad)))
    assert declare.validate_rules(spark, bad, [{"model": "m"}]).count() == len(bad) + 2
    with pytest.raises(ValueError):
        declare.checked_rules(bad)
    rules = declare.checked_rules([good, {"contains": ["B"], "range": [5, 6]}])
    fields = spark.createDataFrame([("m", f) for f in ("xa", "xb", "ab", "c", "text", "text a")], "model string, field string")
    got = declare.declare_ranges(fields, rules, [["TEXT"]])
    assert rows(got, "field", "lo", "hi", "is_non_numeric") == [
        ("text", None, None, True), ("xa", 0.0, 1.0, False), ("xb", 5.0, 6.0, False),
    ]
    found = declare.declare_violations(fields, rules, [["TEXT"]])
    assert rows(found, "field", "kind", "hits") == [
        ("ab", "multiple_rules", [0, 1]), ("c", "missing_rule", []), ("text a", "non_numeric_collision", [0]),
    ]
    with pytest.raises(Exception, match="no single rule"):
        declare.declare_ranges(fields, rules, strict=True).collect()
