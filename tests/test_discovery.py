from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fieldguard.operators import discover
from fieldguard.operators.discover import BlockRule, FieldFilter
from fieldguard.sources import reports as src
from fieldguard.session import shared_dir, small_side
from tests.conftest import rows


def kept(spark, rules, *fields, model="m"):
    df = spark.createDataFrame([(model, f) for f in fields], "model string, field string")
    return [r["field"] for r in discover.filter_fields(df, rules).collect()]


def test_tokens(spark):
    fields = (".<fps>", ".<fps_max>", ".[<name>=<fps>]")
    assert kept(spark, FieldFilter(tokens=["fps"]), *fields) == [".<fps>", ".[<name>=<fps>]"]
    assert kept(spark, FieldFilter(tokens=["fps"], token_mode="contains"), *fields) == list(fields)


def test_sequences(spark):
    fields = ("a.b", "b.a", "ab", "A.B", "aXb\nb")

    def run(mode, case=True, seqs=(("a", "b"),)):
        return kept(spark, FieldFilter(sequences=seqs, sequence_mode=mode, case_sensitive=case), *fields)

    assert run("both") == ["a.b", "b.a", "ab", "aXb\nb"]
    assert run("ordered") == ["a.b", "ab", "aXb\nb"]
    assert run("adjacent") == ["ab"]
    assert run("ordered", case=False) == ["a.b", "ab", "A.B", "aXb\nb"]
    # Matches may not overlap, and may not run backwards.
    assert kept(spark, FieldFilter(sequences=[("aba", "a")], sequence_mode="ordered"), "aba", "abaa") == ["abaa"]
    assert kept(spark, FieldFilter(sequences=[(r"\E(", "+")], sequence_mode="ordered"), r"x\E(y+", "x") == [r"x\E(y+"]
    assert run("both", seqs=((),)) == []


def test_block_and_defaults(spark):
    rules = FieldFilter(block=[BlockRule(["x", "y"]), BlockRule(["z"], ["M2"]), BlockRule([])])
    assert kept(spark, rules, "xy", "x", "z") == ["x", "z"]
    assert kept(spark, rules, "xy", "x", "z", model="m2") == ["x"]
    assert kept(spark, FieldFilter(allow_all_if_empty=False), "x") == []
    # A list that is off but not empty still ends "allow all".
    assert kept(spark, FieldFilter(tokens=["q"], use_tokens=False), "x") == []


def reports(spark, docs):
    return spark.createDataFrame(
        [(m, t, p, r) for m, t, p, r in docs], "model string, taskid string, path string, raw string"
    )


def test_sample_prefers_collect_files(spark):
    df = reports(spark, [("m", "1", "m/1/a.json", "{}"), ("m", "1", "m/1/b_collect.json", "{}"), ("m", "2", "m/2/z.json", "{}"), ("m", "2", "m/2/y.json", "{}")])
    assert rows(discover.sample_reports(df), "path") == [("m/1/b_collect.json",), ("m/2/y.json",)]


def test_union_presence_and_diff(spark):
    df = reports(
        spark,
        [
            ("m", "1", "1", '{"a":1,"b":1}'), ("m", "2", "2", '{"a":1}'), ("m", "3", "3", '{"a":1,"c":1}'),
            ("m", "4", "4", "broken"), ("n", "1", "5", '{"x":1}'),
        ],
    )
    assert rows(discover.union_fields(df)) == [
        ("m", ".<a>", 3, 3), ("m", ".<b>", 1, 3), ("m", ".<c>", 1, 3), ("n", ".<x>", 1, 1),
    ]
    assert rows(discover.union_fields(df, min_ratio=0.5), "field") == [(".<a>",), (".<x>",)]
    loose = discover.union_fields(df, min_ratio=0.5, ratio_by_model={"m": 0.3})
    assert loose.count() == 4
    assert discover.readable_tasks(df).count() == 4
    per_task = discover.task_fields(df)
    base = per_task.filter("model = 'm' and taskid = '1'")
    diff = discover.field_set_diff(per_task.filter("model = 'm'"), base)
    assert rows(diff, "taskid", "side", "field") == [("2", "base", ".<b>"), ("3", "base", ".<b>"), ("3", "sample", ".<c>")]
    with pytest.raises(RuntimeError, match="differ"):
        discover.require_consistent(diff)
    discover.require_consistent(diff.limit(0))
    assert discover.pick_tasks(per_task, 2).filter("model = 'm'").count() == 2
    assert rows(discover.pick_tasks(per_task, 2)) == rows(discover.pick_tasks(per_task, 2))
    assert discover.pick_tasks(per_task, None).count() == 4


def test_clean_field_list(spark):
    lines = ["  .<a> ,", "", "# note", '".<b>"', "'.<c>',", '.<\\"d\\">', ".<a>", '"', "x,,"]
    df = spark.createDataFrame([("m", i, t) for i, t in enumerate(lines)], "model string, pos int, line string")
    got = [r["field"] for r in discover.clean_field_list(df).orderBy("pos").collect()]
    assert got == [".<a>", ".<b>", ".<c>", '.<"d">', '"', "x,"]


def test_model_names(spark):
    texts = {
        '{"model":"A/B"}': "A_B", '{"MODEL" : " x. "}': "x", '{"model":"","robotModel":"R"}': "R",
        '{"model":" ","robotModel":" "}': "none", '{"Model":" ","model":"late"}': "late", "{}": "none", '{"model":5}': "none",
        '{"model":". ."}': "none",
    }
    for raw, want in texts.items():
        df = spark.createDataFrame([("t", "p2", '{"model":"other"}'), ("t", "p1", raw)], "taskid string, path string, raw string")
        assert rows(src.detect_model(df, "none")) == [("t", want)], raw


def test_scan_and_land(spark, tmp_path):
    root = tmp_path / "in 1"
    for model, task, episode, name in (("M 1", "t1", "e1", "e1_collect.json"), ("M 1", "t1", "e2", "e2_collect.json"), ("N", "t+2", "e%3", "e%3.json")):
        folder = root / model / task / episode
        folder.mkdir(parents=True)
        (folder / name).write_text('﻿{"a":1,\n"b":2}', encoding="utf-8")
        (folder / "notes.txt").write_text("x")
    (root / "N" / "t+2" / ".source_preset.json").write_text("{}")
    (root / "N" / "t+2" / "odd.json").write_text("{}")
    df = src.with_path_keys(src.scan_reports(spark, str(root)))
    assert rows(df, "model", "taskid", "episode_id", "filename") == [
        ("M 1", "t1", "e1", "e1_collect.json"), ("M 1", "t1", "e2", "e2_collect.json"),
        ("N", "t+2", "e%3", "e%3.json"), ("N", "t+2", "odd", "odd.json"),
    ]
    assert df.filter("raw like '{%'").count() == 4
    assert src.scan_reports(spark, str(root), "_collect.json").count() == 2
    areas = spark.createDataFrame([("t1", "north"), ("x", "")], "taskid string, area string")
    tagged = src.tag_area(df, areas)
    assert {r["area"] for r in tagged.collect()} == {"north", "N/A"}
    src.land_reports(tagged, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    clash = tagged.unionByName(tagged.withColumn("area", F.lit("south")))
    with pytest.raises(RuntimeError, match="conflict"):
        src.land_reports(clash, str(tmp_path / "out2"))
    assert not (tmp_path / "out2").exists()


def test_task_lists(spark, tmp_path):
    named, plain = tmp_path / "a.csv", tmp_path / "b.csv"
    named.write_text("x,taskid\n1, t1 \n2,\n3,/t2/\n")
    plain.write_text("t1,u1\n t3,u3\n")
    assert rows(src.task_list(spark, str(named))) == [("t1",), ("t2",)]
    assert src.task_list(spark, str(named), "absent").count() == 0
    assert rows(src.task_list(spark, str(plain), None, 0)) == [("t1",), ("t3",)]
    assert rows(src.task_list(spark, str(plain), None, 1, True)) == [("u3",)]
    assert src.task_list(spark, str(plain), None, 7).count() == 0


def test_choices(spark):
    assert src.sources_of("all", ["a", "b"]) == ["a", "b"]
    assert src.sources_of("prod_all", ["a", "b"], ["b"]) == ["b"]
    assert src.sources_of("a", ["a", "b"]) == ["a"]
    with pytest.raises(ValueError):
        src.sources_of("prod_all", ["a"])
    with pytest.raises(KeyError):
        src.sources_of("c", ["a"])
    df = spark.createDataFrame([("m", "a"), ("n", None)], "model string, area string")
    assert src.filter_areas(df, None).count() == 2 and src.filter_areas(df, ["a"]).count() == 1
    with pytest.raises(ValueError):
        src.filter_areas(df, [])
    assert src.select_models(["c", "a", "b"], skip=["a"], start_from="c") == ["c", "b"]
    assert src.select_models(["c", "a", "b"], only=["b", "a"]) == ["a", "b"]
    with pytest.raises(ValueError):
        src.select_models(["a"], skip=["a"], start_from="a")


def test_small_side_drops_the_hint_beyond_its_limit(spark):
    df = spark.range(50)
    assert "broadcast" in small_side(df, 50)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in small_side(df, 49)._jdf.queryExecution().analyzed().toString().lower()
    assert shared_dir(spark) == shared_dir(spark)
