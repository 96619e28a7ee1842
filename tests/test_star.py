from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from fieldguard.functions import labels
from fieldguard.operators import explore, publish, warehouse
from tests.conftest import rows

META = ".<report>.[<ruleCode>=<metadata_raw>].<rawDataMetric>.[<name>=<metadata.json>].<rawData>"


@pytest.mark.parametrize(
    "field, code, name",
    [
        (META + ".<metadata>.<data_info>.<camera_info>.<head>.<type>", "metadata_raw", "head-type"),
        (META + ".<metadata>.<joint_info>.<arm>.[<name>=<x>].<dim>", "metadata_raw", "arm-name-x-dim"),
        (META + ".<metadata>.<equipment_info>.<sn>", "metadata_raw", "equipment_info-sn"),
        (META + ".<size>", "metadata_raw", "rawData-size"),
        (".<report>.[<ruleCode>=<metadata_raw>].<other>", "metadata_raw", ""),
        (".<report>.[<ruleCode>=<fit>].<m>.[<name>=<a>].<n>.[<name>=<b>].<fps>", "fit", "b-fps"),
        (".<plain>.<x>", "", "x"),
        ("nothing", "", ""),
    ],
)
def test_names(spark, field, code, name):
    df = spark.createDataFrame([(field,)], "f string")
    got = df.select(labels.rule_code(F.col("f")).alias("c"), labels.display_name(F.col("f")).alias("n")).first()
    assert (got["c"], got["n"]) == (code, name)


def test_week_labels_match_python(spark):
    days = [date(2024, 1, 1), date(2023, 1, 1), date(2022, 12, 31), date(2021, 1, 3), date(2021, 1, 4), date(2020, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r["d"]: r["w"] for r in df.select("d", labels.week_label(F.col("d")).alias("w")).collect()}
    assert got == {d: d.strftime("%Y-W%W") for d in days}


def test_group_labels_of_unknown_parts(spark):
    df = spark.createDataFrame([(None, None, None, "soon")], "a string, s string, t string, c string")
    for by, want in (("sn", "N/A: N/A"), ("taskid", "N/A"), ("area", "N/A"), ("day", "N/A"), ("week", "N/A"), ("odd", "N/A: N/A")):
        label = labels.group_label(by, F.col("a"), F.col("s"), F.col("t"), F.col("c"))
        assert df.select(label.alias("x")).first()["x"] == want


def test_uri(spark):
    df = spark.createDataFrame(
        [("b", "/t1/", "e", "/f.json"), (None, "t", "e", "f"), ("b", "N/A", "e", "f"), ("b", "t", "", "f"), ("b", "t", "e", "")],
        "b string, t string, e string, f string",
    )
    uri = warehouse.object_uri(F.col("b"), F.col("t"), F.col("e"), F.col("f"))
    got = [r["u"] for r in df.select(uri.alias("u")).collect()]
    assert got == ["obs://b/collect/t1/e/f.json", "N/A", "N/A", "N/A", "N/A"]


def test_latest_documents(spark):
    schema = "model string, episode_id string, filename string, json string"
    old = spark.createDataFrame([("m", "1", "a", "old"), ("m", "2", "a", "kept")], schema)
    new = spark.createDataFrame([("m", "1", "a", "new"), ("m", "3", "x", "x"), ("m", "3", "y", "y")], schema)
    got = warehouse.latest_documents(old, new)
    assert rows(got, "episode_id", "json") == [("1", "new"), ("2", "kept"), ("3", "y")]
    assert warehouse.latest_documents(None, new).count() == 2


def test_refresh_replaces_only_the_models_written(spark, tmp_path):
    path = str(tmp_path / "star")
    field = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "model string, field_id bigint")
    warehouse.write_star({"field": field}, path)
    warehouse.write_star({"field": field.filter("model = 'b' and field_id = 1")}, path)
    assert rows(warehouse.read_star(spark, path, "field"), "model", "field_id") == [("a", 1), ("b", 1)]


def test_wide_and_long(spark):
    wide = spark.createDataFrame([("m", "1", 5, None)], "model string, episode_id string, `.<a>.<b>` int, `.<c>` string")
    long = warehouse.to_long(wide)
    assert rows(long) == [("m", "1", ".<a>.<b>", "5"), ("m", "1", ".<c>", None)]
    assert rows(warehouse.to_wide(long, [".<a>.<b>", ".<c>"])) == [("m", "1", "5", None)]


def test_extra_columns(spark):
    merged = warehouse.merged_columns({"sn": ".a"}, {"sn": ".old", "x": ".x"})
    assert merged == {"sn": ".a", "x": ".x"}
    df = warehouse.with_extra_columns(spark.range(1), {"note": None})
    assert df.first()["note"] is None
    assert warehouse.with_extra_columns(spark.range(1), {"note": None}, "-").first()["note"] == "-"


def test_windows():
    day = date(2024, 3, 1)
    assert explore.relative_window("7d", day) == ("2024-02-23", "2024-03-02")
    assert explore.relative_window("30d", day, 5) == ("2024-01-31", "2024-03-02")
    assert explore.relative_window("all", day) is None
    assert explore.relative_window("all", day, 0) is None
    assert explore.relative_window("all", day, 3) == ("2024-02-27", "2024-03-02")
    assert explore.relative_window("1y", day) is None


def test_window_edges(spark):
    times = ["2024-02-22 23:59:59", "2024-02-23", "2024-03-01T23:59:59Z", "2024-03-02", "soon", None]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    kept = df.filter(explore.in_window(F.col("t"), ("2024-02-23", "2024-03-02")))
    assert [r["t"] for r in kept.collect()] == times[1:3]
    assert df.filter(explore.in_window(F.col("t"), None)).count() == len(times)


@pytest.mark.parametrize("chunk_rows", [20, 1 << 20])
def test_sample_quota(spark, chunk_rows):
    data = [("m", "hot" if i % 3 else f"t{i % 5}", str(i)) for i in range(300)] + [("m", "lone", "x")]
    df = spark.createDataFrame(data, "model string, taskid string, episode_id string")
    got = explore.stratified_sample(df, 10, "s", chunk_rows=chunk_rows)
    sizes = {r["taskid"]: r["count"] for r in got.groupBy("taskid").count().collect()}
    whole = {r["taskid"]: r["count"] for r in df.groupBy("taskid").count().collect()}
    assert sizes == {t: max(1, n // 10) for t, n in whole.items()}
    again = explore.stratified_sample(df, 10, "s", chunk_rows=7)
    assert rows(got) == rows(again)
    assert explore.stratified_sample(df, 100).count() == 301


def test_thresholds_and_plot_values(spark):
    fields = spark.createDataFrame(
        [("m", 1, "a", "numeric"), ("m", 2, "b", "non_numeric"), ("m", 3, "c", "")],
        "model string, field_id bigint, field string, type string",
    )
    base = spark.createDataFrame(
        [("m", "a", "1", "2.5"), ("m", "b", "true", "true")], "model string, field string, min string, max string"
    )
    full = spark.createDataFrame([("m", "a", None, "9")], base.schema)
    got = explore.threshold_lookup(fields, base, full)
    assert rows(got, "field", "base_lo", "base_hi", "full_lo", "full_hi", "has_threshold") == [
        ("a", 1.0, 2.5, None, 9.0, True), ("b", None, None, None, None, False), ("c", None, None, None, None, False),
    ]
    cells = spark.createDataFrame(
        [("m", 1, "3"), ("m", 1, "x"), ("m", 1, None), ("m", 2, " N/A "), ("m", 2, "v"), ("m", 2, None), ("m", 3, "4"), ("m", 9, "4")],
        "model string, field_id bigint, value string",
    )
    shown = explore.plot_values(cells, fields)
    assert rows(shown, "field_id", "value", "value_num") == sorted(
        [(1, "3", 3.0), (1, None, None), (1, "x", None), (2, " N/A ", 1.0), (2, None, 1.0), (2, "v", 0.0), (3, "4", 4.0), (9, "4", None)],
        key=lambda r: tuple(map(str, r)),
    )


def test_group_stats_counts_text_as_neither(spark):
    fields = spark.createDataFrame([("m", 1, "numeric")], "model string, field_id bigint, type string")
    cells = spark.createDataFrame(
        [("m", 1, v, "a", "s", "t", "2024-01-01") for v in ("1", "9", "x", None)],
        "model string, field_id bigint, value string, area string, sn string, taskid string, collected_at string",
    )
    bounds = spark.createDataFrame([("m", 1, 0.0, 5.0)], "model string, field_id bigint, base_lo double, base_hi double")
    got = explore.group_stats(cells, fields, bounds).first()
    assert got["group_key"] == "a: s"
    assert (got["mean"], got["pass_rate"], got["pass_count"], got["fail_count"]) == (5.0, 50.0, 1, 1)
    assert (got["missing_count"], got["missing_rate"]) == (1, 25.0)
    none = explore.group_stats(cells, fields, bounds.withColumn("base_hi", F.lit(None).cast("double"))).first()
    assert none["pass_rate"] is None and none["pass_count"] == 0 and none["fail_count"] == 0


def test_pages(spark):
    fields = spark.createDataFrame(
        [("m", i, f"f{i:02d}", "r") for i in range(20)], "model string, field_id bigint, field string, rule_code string"
    )
    for number, want in ((1, 9), (3, 2), (99, 2), (-4, 9)):
        assert explore.page(fields, "m", "r", number).count() == want
    assert explore.search_field(fields.withColumn("field_name", F.lit("")), "m", "  ").count() == 0
    hit = explore.search_field(fields.withColumn("field_name", F.lit(" ")), "m", " f01 ").first()
    assert hit["display_name"] == "f01"


def test_literals_are_reversible(spark):
    texts = ["a\nb", "a\\nb", "\\", "\\\\n", "a\r\nb\rc", "", "\\\n", "'q'"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    lit = publish.escape_literal(F.col("t"))
    for r in df.select("t", lit.alias("l"), publish.unescape_literal(lit).alias("b")).collect():
        assert "\n" not in r["l"] and "\r" not in r["l"]
        assert r["b"] == r["t"].replace("\r\n", "\n").replace("\r", "\n")


def test_publish(spark, tmp_path):
    ranges = spark.createDataFrame(
        [("m'1", "base", 'f,"x"', 1.0, 2.5, False), ("m'1", "base", "a", None, None, True), ("n", "full", "a", 0.0, 1.0, False)],
        "model string, variant string, field string, lo double, hi double, is_non_numeric boolean",
    )
    packed = publish.pack_ranges(ranges)
    literal = {r["model"]: r["literal"] for r in packed.collect()}
    assert literal["m'1"] == 'field,min,max\\na,true,true\\n"f,""x""",1.0,2.5\\n'
    statements = [r["statement"] for r in publish.update_statements(packed).collect()]
    assert statements[0].endswith("WHERE model='m''1';") and "f,\"\"x\"\"" in statements[0]
    ids = publish.rule_ids(spark, {"7": " n ", "x": "m'1", 8: None, 9: ""})
    assert rows(ids) == [("n", 7)]
    assert rows(publish.missing_ids(packed, ids)) == [("m'1",)]
    noted = publish.export_version(ranges, str(tmp_path), "v1")
    assert rows(noted) == [("m'1", "base", "range/m'1/base/v1"), ("n", "full", "range/n/full/v1")]
    with pytest.raises(Exception):
        publish.export_version(ranges, str(tmp_path), "v1")
    for model, variant, path in [tuple(r) for r in noted.collect()]:
        back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/{path}")
        want = ranges.filter((ranges.model == model) & (ranges.variant == variant))
        assert rows(back, "field") == rows(want, "field") and back.columns[:3] == ["field", "min", "max"]
    other = ranges.filter("model = 'n'").withColumn("model", F.lit("second"))
    assert rows(publish.export_version(other, str(tmp_path), "v1")) == [("second", "full", "range/second/full/v1")]
    with pytest.raises(KeyError):
        publish.payload_rows(packed, ids, on_missing="error")
    odd = spark.createDataFrame([("9007199254740993", "a", 1), ("1e3", "b", 1), (" 12 ", "c", 1)], "id_text string, model string, pos int")
    assert rows(publish.reversed_ids(odd)) == [("a", 9007199254740993), ("c", 12)]
    bodies = publish.payload_rows(packed, ids, noted)
    assert rows(bodies, "key", "body") == [
        ("configFull", '{"id":7,"configFull":"field,min,max\\\\na,0.0,1.0\\\\n"}'),
        ("csvFullPath", '{"id":7,"csvFullPath":"range/n/full/v1"}'),
    ]


def test_write_per_field(spark, tmp_path):
    from fieldguard.operators.extract import write_per_field

    values = spark.createDataFrame(
        [("m", str(i), f, "v") for i in range(50) for f in (".<a>", ".<b>.<c>")],
        "model string, episode_id string, field string, value string",
    )
    write_per_field(values, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["field_file"], r["count"]) for r in back.groupBy("field_file").count().collect()} == {
        ("__a_", 50), ("__b___c_", 50),
    }


def test_star_keeps_model_names_and_new_columns(spark, tmp_path):
    one = spark.createDataFrame([("007", 1, "f"), ("7", 2, "f")], "model string, field_id int, field string")
    warehouse.write_star({"field": one}, str(tmp_path))
    warehouse.write_star({"field": one.filter("model = '7'").withColumn("unit", F.lit("m"))}, str(tmp_path))
    back = warehouse.read_star(spark, str(tmp_path), "field")
    assert rows(back, "model", "unit") == [("007", None), ("7", "m")]
    with pytest.raises(Exception, match="has no model"):
        warehouse.write_star({"field": one.withColumn("model", F.lit(" "))}, str(tmp_path))


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_times_are_utc(spark, zone):
    texts = ["2024-01-01T23:30:00Z", "2024-01-01 23:30:00", "2024-01-02T07:30:00+08:00", "2024-01-01", "x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        none = F.lit(None).cast("string")
        days = df.select("i", labels.group_label("day", none, none, none, F.col("t")).alias("d"))
        assert [r.d for r in days.orderBy("i").collect()] == ["2024-01-01"] * 4 + ["N/A"] * 2
        inside = df.filter(explore.in_window(F.col("t"), ("2024-01-01", "2024-01-02")))
        assert inside.count() == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
