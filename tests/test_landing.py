"""Bucketed landing: same rows as the plain operators, and no document in an exchange."""

from __future__ import annotations

import re
from uuid import uuid4

import pytest

from fieldguard.operators import discover
from fieldguard.sources import landing, reports

from .conftest import rows

SCHEMA = "model string, taskid string, path string, raw string, area string"
COLUMNS = ["model", "taskid", "path", "raw"]


def _reports():
    """One task holds more than a third of the rows; one has no id; some paths repeat."""
    out = []
    for i in range(240):
        task = "hot" if i % 5 < 2 else f"t{i % 37}"
        suffix = "_collect.json" if i % 3 else ".json"
        out.append((f"m{i % 2}", task, f"m/{task}/{i:04d}{suffix}", f'{{"model": "r{i % 4}", "i": {i}}}', "old"))
    out += [out[7], out[7], ("m1", None, "m/none.json", '{"model": "lost"}', None)]
    return out


@pytest.fixture(scope="module")
def flat(spark):
    return spark.createDataFrame(_reports(), SCHEMA)


@pytest.fixture(scope="module")
def place(spark, flat):
    name = f"landing_{uuid4().hex}"
    made = landing.land_by_task(flat, name, 8)
    yield made
    spark.sql(f"DROP TABLE {name}")


@pytest.fixture
def never_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanged(df) -> list[str]:
    """What each exchange of the plan takes in."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)


def _tasks(spark):
    return spark.createDataFrame([("hot",), ("t3",), ("t8",), ("t8",), ("unknown",), (None,)], "taskid string")


def _areas(spark):
    return spark.createDataFrame([("hot", "b"), ("hot", "a"), ("t3", ""), ("t8", "c")], "taskid string, area string")


def test_hot_tasks_are_few_and_salted(place, flat):
    (task, salts), = rows(place.hot)
    assert task == "hot" and salts == -(-flat.filter("taskid = 'hot'").count() * 8 // flat.count())
    found = place.table.filter("taskid = 'hot'").select(landing.SALT).distinct().count()
    assert found == salts
    assert place.table.filter("taskid is null or taskid <> 'hot'").filter(f"{landing.SALT} <> 0").count() == 0


def test_landing_keeps_all_rows(place, flat):
    assert rows(place.reports, *COLUMNS) == rows(flat, *COLUMNS)


@pytest.mark.parametrize("limit", [1, 1000])
def test_same_rows_as_the_plain_operators(spark, place, flat, never_broadcast, limit):
    kept = landing.restrict_tasks(place, _tasks(spark), limit)
    assert rows(kept, *COLUMNS) == rows(reports.restrict_tasks(flat, _tasks(spark)), *COLUMNS)
    named = landing.assign_model(place, max_rows=limit)
    assert rows(named, *COLUMNS) == rows(reports.assign_model(flat), *COLUMNS)
    for default in ("N/A", None):
        tagged = landing.tag_area(place, _areas(spark), default, limit)
        assert rows(tagged, *COLUMNS, "area") == rows(reports.tag_area(flat, _areas(spark), default), *COLUMNS, "area")
    picked = landing.sample_reports(place, limit).filter("taskid is not null")
    assert rows(picked, *COLUMNS) == rows(discover.sample_reports(flat).filter("taskid is not null"), *COLUMNS)


def test_no_exchange_carries_documents(spark, place, never_broadcast):
    made = {
        "restrict": landing.restrict_tasks(place, _tasks(spark), 1),
        "model": landing.assign_model(place, max_rows=1),
        "area": landing.tag_area(place, _areas(spark), max_rows=1),
        "sample": landing.sample_reports(place, 1),
    }
    for name, df in made.items():
        taken = exchanged(df)
        assert taken, name
        assert not [x for x in taken if re.search(r"\braw#", x)], name


def test_a_later_job_finds_the_landing(spark, flat):
    name = f"landing_{uuid4().hex}"
    landing.land_by_task(flat, name)
    again = landing.landed(spark, name)
    assert rows(landing.restrict_tasks(again, _tasks(spark), 1), *COLUMNS) == rows(
        reports.restrict_tasks(flat, _tasks(spark)), *COLUMNS
    )
    spark.sql(f"DROP TABLE {name}")


def test_an_empty_collection(spark):
    name = f"landing_{uuid4().hex}"
    place = landing.land_by_task(spark.createDataFrame([], SCHEMA), name, 4)
    assert rows(place.hot) == [] and rows(landing.sample_reports(place)) == []
    assert rows(landing.restrict_tasks(place, _tasks(spark), 1)) == []
    spark.sql(f"DROP TABLE {name}")
