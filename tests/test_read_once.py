"""Steps that read, parse or count once what they used to do several times give the same rows."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from fieldguard.functions import selectors as sel
from fieldguard.operators import audit, explore, extract, flatten, learn
from fieldguard.plans import exploring
from tests.conftest import rows

DIR = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_counted_cells_learn_and_audit_alike(spark):
    cells = [("m", str(i), "a", str(i % 7)) for i in range(40)] + [("m", str(i), "b", "true") for i in range(5)]
    cells += [("m", "1", "c", None), ("m", "2", "c", "x"), ("m", "3", "c", "NaN"), (None, "4", "a", "2")]
    values = spark.createDataFrame(cells, "model string, episode_id string, field string, value string")
    counted = extract.count_cells(values)
    ranges = learn.learn_ranges(values)
    assert rows(learn.learn_ranges(counted)) == rows(ranges)
    episodes = values.select("model", "episode_id").distinct()
    modes = ({}, {"fields_mode": "values_only", "missing_range_is_fail": True}, {"treat_nan_as_fail": False})
    for mode in modes:
        p = audit.AuditParams(**mode)
        want = rows(audit.audit_fields(values, ranges, episodes, p))
        assert rows(audit.audit_fields(counted, ranges, episodes, p)) == want


def test_event_star_parses_reports_once(spark):
    _, fields, fact = exploring.event_star(spark, DIR)
    assert "from_json" not in _plan(fact) and "from_json" not in _plan(fields)


def test_axis_of_a_model(spark):
    said = [("m", f"e{i % 5}", i % 2, "s", "t", f"2024-01-0{1 + i % 3}") for i in range(10)]
    drawn = spark.createDataFrame(said, "model string, episode_id string, field_id int, sn string, taskid string, collected_at string")
    whole = explore.episode_index(drawn, "time", "week", per_field=False)
    want = rows(whole.select("model", "episode_id", "episode_index").distinct())
    for chunk in (1 << 20, 2):
        assert rows(explore.model_axis(drawn, "time", "week", chunk_rows=chunk).distinct()) == want
    timed = explore.with_time(drawn).drop("collected_at")
    assert rows(explore.episode_index(timed, settled=True)) == rows(explore.episode_index(drawn).drop("collected_at"))


def test_discriminators_are_parsed_once(spark):
    step = sel.parse(".[t=50]")[0]
    assert sel._text_step("_t", step, "typed").count("from_json") == 2
    raws = ['{"items":[7,{"t":50,"v":"n"},{"t":"50","v":"s"},null,{"v":1}]}', '{"items":[{"t":50.0,"v":[1]}]}', "{}", "no"]
    df = spark.createDataFrame(list(enumerate(raws)), "episode_id int, raw string")
    fields = [".<items>.[t=50].<v>", ".<items>.[<t>=<50>].<v>", ".<items>.[t=51].<v>", ".<items>.(1).<t>"]
    got = sel.parse_reports(df, fields, keep=["episode_id"])
    want = [(0, ["n", "s", None, "50"]), (1, ["[1]", None, None, None]), (2, [None] * 4), (3, None)]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_leaves_are_counted_where_they_are_walked(spark):
    raws = ['{"a":[{"k":1,"v":null},{"k":true,"v":2},{"k":"1","v":3}],"b":"x"}', '{"b":"x","c":[]}', "no", None]
    raws += [json.dumps({"id": str(i), "b": "x"}) for i in range(30)]
    df = spark.createDataFrame([("m" if i % 2 else None, r) for i, r in enumerate(raws)], "model string, raw string")
    want = flatten.flatten_any(df, ("model",)).groupBy("model", "field", "value").agg(F.count("*").alias("n"))
    assert rows(flatten.count_leaves(df)) == rows(want)
    assert rows(flatten.count_leaves(df.limit(0))) == []
