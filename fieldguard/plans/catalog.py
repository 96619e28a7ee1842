"""All registered queries and their checking SQL."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

from fieldguard.plans import auditing

_SECTIONS = ("finding", "learning", "auditing", "exploring")
QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in _SECTIONS:
    _section = importlib.import_module(f"fieldguard.plans.{_name}")
    QUERIES |= _section.QUERIES
    SQL |= _section.SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn ranges from all order reports and audit the reports against them."""
    return auditing.t1_learn_and_audit(spark, sf_dir)
