from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fieldguard.functions import selectors as sel
from fieldguard.operators import extract, flatten
from tests.conftest import rows

Step = sel.Step


def test_parse_forms():
    assert sel.parse(".<a>.b.(2).[<k>=<v>].[n=3].[t=x y].[<z>=true]") == (
        Step("key", "a"),
        Step("key", "b"),
        Step("item", index=2),
        Step("match", "k", value="v"),
        Step("match", "n", value=3),
        Step("match", "t", value="x y"),
        Step("match", "z", value=True),
    )


def test_parse_loosely():
    want = sel.parse(".report.[<k>=<v>].<x>.<y>")
    assert sel.parse("report[<k>=<v>]<x>.y", loose=True) == want
    with pytest.raises(sel.SelectorError):
        sel.parse("report[<k>=<v>]<x>.y")


def test_parse_unescapes_and_keeps_odd_characters():
    assert sel.parse(r".<a\>b\\c>.[<k]>=<x]y>].<b'/é.d>") == (
        Step("key", r"a>b\c"),
        Step("match", "k]", value="x]y"),
        Step("key", "b'/é.d"),
    )


@pytest.mark.parametrize("text", ["", "a.b", ".", ".<a", ".[<a>]", ".(x)", ".<a>b", ".<a>..<b>"])
def test_malformed(spark, text):
    with pytest.raises(sel.SelectorError):
        sel.parse(text)
    df = spark.createDataFrame([("m", text)], "model string, field string")
    assert extract.selector_violations(df).count() == 1


def test_well_formed_column_agrees_with_parse(spark):
    good = [".<a>", ".a.b", ".(0)", ".( -1 )", ".[<k>=<v>].x", r".<a\>b>", ".[k=v]", ".[k=]"]
    df = spark.createDataFrame([("m", g) for g in good], "model string, field string")
    assert extract.selector_violations(df).count() == 0
    for text in good:
        sel.parse(text)


DOCS = {
    "bad": "not json",
    "cut": '{"a":1',
    "dup": '{"a":1,"a":2}',
    "nan": '{"a":NaN,"b":-Infinity}',
    "scalar": '{"report":7}',
    "mixed": '{"report":[1,"s",null,[2],{"code":3,"v":"num"},{"code":"3","v":"text"}]}',
    "twice": '{"report":[{"code":"3","v":"first"},{"code":"3","v":"second"}]}',
    "slash": '{"a/b c\'":{"x.y":"deep"}}',
    "empty": '{"a":{},"b":[]}',
    "top": "[1,2]",
    "typed": '{"a":"{\\"z\\":1}","b":[true,null,1.5]}',
    "case": '{"Key":"upper","key":"lower"}',
    "blank": '{"":{"":"inner"},"one":[{"t":1,"v":"n"},{"t":true,"v":"b"}]}',
    "bool": '{"report":[{"code":true,"v":"yes"},{"code":"true","v":"text"}]}',
}


def read(spark, selectors, match="typed", only=None):
    data = [("m", k, v) for k, v in DOCS.items() if only is None or k in only]
    df = spark.createDataFrame(data, "model string, episode_id string, raw string")
    out = extract.extract_values(df, selectors, match=match)
    return {(r["episode_id"], r["field"]): r["value"] for r in out.collect()}


def test_unreadable_reports_are_left_out(spark):
    got = read(spark, [".<a>"])
    assert {k for k, _ in got} == set(DOCS) - {"bad", "cut"}


def test_strict_mode_raises(spark):
    df = spark.createDataFrame([("m", "e", "not json")], "model string, episode_id string, raw string")
    with pytest.raises(Exception, match="not JSON"):
        extract.extract_values(df, [".<a>"], strict=True).collect()
    with pytest.raises(sel.SelectorError):
        extract.extract_values(df, ["a"], strict=True)


def test_values(spark):
    got = read(
        spark,
        [".<a>", ".<b>", ".<b>.(1)", ".<b>.(-1)", ".<b>.(0)", ".<a/b c'>.<x.y>", "broken", ".<Key>", ".<key>"],
    )
    assert got["dup", ".<a>"] == "2"
    assert got["nan", ".<a>"] == "NaN" and got["nan", ".<b>"] == "-Infinity"
    assert got["slash", ".<a/b c'>.<x.y>"] == "deep"
    assert got["empty", ".<a>"] == "{}" and got["empty", ".<b>"] == "[]"
    assert got["typed", ".<a>"] == '{"z":1}'
    assert got["typed", ".<b>"] == "[true,null,1.5]"
    assert got["typed", ".<b>.(0)"] == "true"
    assert got["typed", ".<b>.(1)"] is None and got["typed", ".<b>.(-1)"] is None
    assert got["typed", "broken"] is None
    assert got["case", ".<Key>"] == "upper" and got["case", ".<key>"] == "lower"


def test_odd_keys_and_equal_looking_values(spark):
    got = read(spark, [".<>.<>", ".<one>.[t=true].<v>", ".<one>.[t=1].<v>", ".<one>.[t=null].<v>"], only=["blank"])
    assert got["blank", ".<>.<>"] == "inner"
    assert got["blank", ".<one>.[t=true].<v>"] == "b" and got["blank", ".<one>.[t=1].<v>"] == "n"
    assert got["blank", ".<one>.[t=null].<v>"] is None
    raw = """{"a'b\\\\`c":[{"k'\\\\":"v'\\\\","x`y":"found"}]}"""
    df = spark.createDataFrame([("m", "1", raw)], "model string, episode_id string, raw string")
    field = r".<a'b\\`c>.[<k'\\>=<v'\\>].<x`y>"
    assert extract.extract_values(df, [field]).first()["value"] == "found"


def test_filters_take_the_first_match_by_type(spark):
    quoted, bare = ".<report>.[<code>=<3>].<v>", ".<report>.[code=3].<v>"
    got = read(spark, [quoted, bare, ".<report>.[code=true].<v>", ".<report>.(4).<v>"])
    assert got["mixed", quoted] == "text" and got["mixed", bare] == "num"
    assert got["mixed", ".<report>.(4).<v>"] == "num"
    assert got["twice", quoted] == "first" and got["twice", bare] is None
    assert got["scalar", quoted] is None
    assert got["bool", ".<report>.[code=true].<v>"] == "yes"
    text = read(spark, [quoted], match="text")
    assert text["mixed", quoted] == "num"


def test_a_place_may_be_leaf_and_container(spark):
    got = read(spark, [".<report>", ".<report>.[<code>=<3>]", ".<report>.[<code>=<3>].<v>"], only=["twice"])
    assert got["twice", ".<report>.[<code>=<3>].<v>"] == "first"
    assert json.loads(got["twice", ".<report>.[<code>=<3>]"]) == {"code": "3", "v": "first"}
    assert len(json.loads(got["twice", ".<report>"])) == 2


def test_fields_per_model(spark):
    df = spark.createDataFrame(
        [("m", "1", '{"a":1,"b":2}'), ("n", "2", '{"a":3}'), ("o", "3", '{"a":3}')],
        "model string, episode_id string, raw string",
    )
    got = extract.extract_values(df, {"m": [".<b>", ".<a>"], "n": [".<a>"]})
    assert rows(got) == [("m", "1", ".<a>", "1"), ("m", "1", ".<b>", "2"), ("n", "2", ".<a>", "3")]


def test_document_is_parsed_once(spark):
    df = spark.createDataFrame([("m", "1", "{}")], "model string, episode_id string, raw string")
    fields = [f".<r>.[<c>=<{c}>].<{leaf}>" for c in "abc" for leaf in "xyz"]
    plan = extract.extract_values(df, fields)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("AS _doc" in line for line in plan.splitlines()) == 1
    assert not any("Filter" in line and "from_json" in line for line in plan.splitlines())
    # One look-up per discriminator, shared by its leaves.
    assert plan.count("[0] AS _at") == 3


def test_flatten_order_and_escapes(spark):
    raw = '{"b>\\\\":1,"a":[{"k":1,"x":null},{"k":"1","y":[1,{"q":2}]},3,{}],"c":{},"d":[1,2]}'
    assert list(flatten.leaves(json.loads(raw))) == [
        (r".<b\>\\>", "1"),
        (".<a>.[<k>=<1>].<k>", "1"),
        (".<a>.[<k>=<1>].<x>", None),
        (".<a>.[<k>=<1>].<y>.[<q>=<2>].<q>", "2"),
        (".<d>", "[1,2]"),
    ]


def test_flattened_selectors_extract_the_same_values(spark):
    docs = [
        '{"a>b":"x","n":{"o\\\\p":[1,2],"q":null},"r":[{"code":"u","m":[{"name":"w","v":1.5}]}]}',
        '{"r":[{"code":"u","m":[{"name":"w","v":true},{"name":"z","v":"t"}]},{"code":"s"}]}',
    ]
    df = spark.createDataFrame(
        [("m", "t", str(i), d) for i, d in enumerate(docs)],
        "model string, taskid string, episode_id string, raw string",
    )
    leaves = flatten.flatten_any(df).select("episode_id", "field", "value")
    fields = [r["field"] for r in leaves.select("field").distinct().collect()]
    values = extract.extract_values(df, fields)
    back = leaves.join(values.withColumnRenamed("value", "got"), ["episode_id", "field"])
    assert back.count() == leaves.count()
    assert back.filter(~F.col("value").eqNullSafe(F.col("got"))).count() == 0


def test_select_cells_default_and_drop_empty(spark):
    data = [("m", k, v) for k, v in DOCS.items()]
    df = spark.createDataFrame(data, "model string, episode_id string, raw string")
    got = dict(rows(extract.select_cells(df, {"x": ".<a>"}, keep=["episode_id"])))
    assert got["dup"] == "2" and got["scalar"] == "N/A" and "bad" not in got
    values = extract.extract_values(df, [".<a>", ".<gone>", ".<b>"])
    kept = extract.drop_empty_fields(values.filter("episode_id in ('empty', 'dup')"))
    assert {r["field"] for r in kept.collect()} == {".<a>"}
    assert extract.drop_empty_cells(values).filter("episode_id = 'empty'").count() == 0
