from __future__ import annotations

import pytest

from fieldguard.operators import audit
from fieldguard.operators.audit import AuditParams
from tests.conftest import rows

VALUES = "model string, episode_id string, field string, value string"
RANGES = "model string, variant string, field string, lo double, hi double, is_non_numeric boolean, is_bool boolean"


@pytest.fixture(scope="module")
def data(spark):
    cells = {
        "num": ["1", "5", "9", "x", None],
        "text": ["a", " ", "nan", "NA", "b"],
        "flag": ["true", "false", "true", None, "maybe"],
        "loose": ["1", "2", "3", "4", "5"],
    }
    values = spark.createDataFrame(
        [("m", f"e{i}", f, v) for f, vs in cells.items() for i, v in enumerate(vs)], VALUES
    )
    ranges = spark.createDataFrame(
        [
            ("m", "base", "num", 2.0, 9.0, False, False),
            ("m", "base", "text", None, None, True, False),
            ("m", "base", "flag", 1.0, 1.0, False, True),
            ("m", "base", "gone", 0.0, 1.0, False, False),
            ("m", "full", "num", 0.0, 4.0, False, False),
            ("m", "full", "loose", None, 4.0, False, False),
        ],
        RANGES,
    )
    episodes = spark.createDataFrame([("m", f"e{i}") for i in range(5)], "model string, episode_id string")
    return values, ranges, episodes


def stats(data, **kw):
    values, ranges, episodes = data
    got = audit.audit_fields(values, ranges, episodes, AuditParams(**kw))
    return {(r["variant"], r["field"]): (r["pass_count"], r["fail_count"], r["pass_rate"]) for r in got.collect()}


def test_fields(data):
    assert stats(data) == {
        ("base", "num"): (2, 3, 0.4),
        ("base", "text"): (2, 3, 0.4),
        ("base", "flag"): (2, 3, 0.4),
        ("base", "gone"): (0, 5, 0.0),
        ("full", "num"): (1, 4, 0.2),
        ("full", "loose"): (0, 5, 0.0),
    }


def test_policies(data):
    lenient = stats(data, treat_nan_as_fail=False, missing_value_col_is_fail=False)
    assert lenient["base", "num"] == (2, 1, pytest.approx(2 / 3))
    assert lenient["base", "text"] == (2, 3, 0.4)
    assert lenient["base", "flag"] == (2, 1, pytest.approx(2 / 3))
    assert ("base", "gone") not in lenient
    assert lenient["full", "loose"] == (0, 5, 0.0)


def test_scope(data):
    got = stats(data, fields_mode="values_only")
    assert ("base", "gone") not in got and ("base", "loose") not in got
    strict = stats(data, fields_mode="values_only", missing_range_is_fail=True)
    assert strict["base", "loose"] == (0, 5, 0.0)
    assert strict["full", "text"] == (0, 5, 0.0)
    assert ("base", "gone") not in strict


def test_write_back(data):
    values, ranges, episodes = data
    got = audit.with_stats(ranges, audit.audit_fields(values, ranges, episodes, AuditParams(missing_value_col_is_fail=False)))
    assert rows(got.filter("field = 'gone'"), "lo", "pass_count", "pass_rate") == [(0.0, None, None)]
    again = audit.with_stats(got, audit.audit_fields(values, ranges, episodes))
    assert again.columns == got.columns and again.count() == 6


def test_scorecard_sums_equal_field_sums(data):
    values, ranges, episodes = data
    card = audit.episode_scorecard(values, ranges)
    by_variant = {r["variant"]: r for r in card.groupBy("variant").sum("pass_fields", "fail_fields").collect()}
    fields = stats(data)
    for variant in ("base", "full"):
        mine = [v for (k, _), v in fields.items() if k == variant]
        assert by_variant[variant]["sum(pass_fields)"] == sum(p for p, _, _ in mine)
        assert by_variant[variant]["sum(fail_fields)"] == sum(f for _, f, _ in mine)
    first = card.filter("variant = 'base' and episode_id = 'e0'").first()
    assert (first["total_fields"], first["pass_fields"], first["pass_rate"]) == (4, 2, 0.5)
    known = values.select("model", "field").distinct()
    assert rows(audit.episode_scorecard(values, ranges, extracted=known)) == rows(card)


def test_model_pass_rate(data):
    values, ranges, episodes = data
    strict = audit.model_pass_rate(values, ranges, episodes)
    assert rows(strict) == [("m", "base", 0, 5, 0.0), ("m", "full", 0, 5, 0.0)]
    only = ranges.filter("field in ('num', 'flag')")
    got = audit.model_pass_rate(values, only, episodes)
    assert rows(got) == [("m", "base", 1, 5, 0.2), ("m", "full", 1, 5, 0.2)]
    loose = audit.model_pass_rate(values, only, episodes, AuditParams(treat_nan_as_fail=False))
    assert rows(loose)[0] == ("m", "base", 3, 5, 0.6)
    missing = AuditParams(fields_mode="values_only", missing_range_is_fail=True)
    assert rows(audit.model_pass_rate(values, only, episodes, missing))[0] == ("m", "base", 0, 5, 0.0)


def test_details_and_tops(data):
    values, ranges, episodes = data
    got = audit.fail_details(values, ranges.filter("variant = 'base'"), 2)
    assert rows(got, "field", "episode_id", "reason") == [
        ("flag", "e1", "out_of_range"), ("flag", "e3", "nan"),
        ("gone", "<all>", "missing_value_column"),
        ("num", "e0", "out_of_range"), ("num", "e3", "nan"),
        ("text", "e1", "empty"), ("text", "e2", "empty"),
    ]
    assert audit.fail_details(values, ranges.filter("variant = 'base'"), 0).count() == 10
    top = audit.top_failing_fields(audit.audit_fields(values, ranges, episodes), 2)
    assert rows(top, "variant", "rank", "field") == [
        ("base", 1, "gone"), ("base", 2, "flag"), ("full", 1, "loose"), ("full", 2, "num"),
    ]
    worst = audit.top_failing_episodes(audit.episode_scorecard(values, ranges), 1)
    assert rows(worst, "variant", "episode_id") == [("base", "e3"), ("full", "e1")]


def test_values_are_read_once_and_ranges_broadcast(data):
    values, ranges, episodes = data
    plan = audit.audit_fields(values, ranges, episodes)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan.split("HashAggregate")[-1]
    assert "BroadcastHashJoin" in plan
