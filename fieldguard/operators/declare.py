"""Hand-declared ("full") ranges: every field must fall under exactly one rule."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldguard.functions.intervals import texts_occur

VIOLATION = "list string, position int, problem string"
_MODEL_KEYS = {"model", "models"}
_CLAMP_KEYS = {"min_lo", "max_lo", "min_hi", "max_hi"}


@dataclass(frozen=True)
class DeclaredRule:
    contains: Sequence[str]
    lo: float
    hi: float


def rule_problems(
    range_rules: Sequence[Mapping[str, object]], non_numeric_rules: Sequence[Mapping[str, object]]
) -> list[tuple[str, int, str]]:
    """What is wrong with rules given as plain mappings: (list, position, problem)."""
    found: list[tuple[str, int, str]] = []

    def common(kind: str, at: int, rule: Mapping[str, object]) -> None:
        if _MODEL_KEYS & set(rule):
            found.append((kind, at, "names models"))
        if "contains" not in rule:
            found.append((kind, at, "no contains"))

    for at, rule in enumerate(non_numeric_rules):
        common("non_numeric", at, rule)
    for at, rule in enumerate(range_rules):
        common("range", at, rule)
        if _CLAMP_KEYS & set(rule):
            found.append(("range", at, "has clamp keys"))
        if "range" not in rule:
            found.append(("range", at, "no range"))
            continue
        ends = rule["range"]
        if not isinstance(ends, (list, tuple)) or len(ends) != 2:
            found.append(("range", at, "range is not a pair"))
        elif ends[0] is None or ends[1] is None:
            found.append(("range", at, "range holds null"))
        else:
            try:
                lo, hi = float(ends[0]), float(ends[1])
            except (TypeError, ValueError):
                found.append(("range", at, "range is not numeric"))
                continue
            if not (math.isfinite(lo) and math.isfinite(hi)):
                found.append(("range", at, "range is not finite"))
            elif lo > hi:
                found.append(("range", at, "lo above hi"))
    return found


def validate_rules(
    spark: SparkSession,
    range_rules: Sequence[Mapping[str, object]],
    non_numeric_rules: Sequence[Mapping[str, object]] = (),
) -> DataFrame:
    """The problems of :func:`rule_problems` as rows."""
    return spark.createDataFrame(rule_problems(range_rules, non_numeric_rules), VIOLATION)


def checked_rules(
    range_rules: Sequence[Mapping[str, object]], non_numeric_rules: Sequence[Mapping[str, object]] = ()
) -> list[DeclaredRule]:
    """Typed rules, or ValueError if any rule is unusable."""
    problems = rule_problems(range_rules, non_numeric_rules)
    if problems:
        raise ValueError(f"unusable rules: {problems}")
    return [
        DeclaredRule(r["contains"], float(r["range"][0]), float(r["range"][1])) for r in range_rules
    ]


def _hits(name: Column, rules: Sequence[DeclaredRule], fold_case: bool) -> Column:
    """Array of the matching rules (position, lo, hi), in order."""
    schema = "array<struct<pos:int,lo:double,hi:double>>"
    if not rules:
        return F.array().cast(schema)
    marked = [
        F.when(
            texts_occur(name, rule.contains, fold_case),
            F.struct(
                F.lit(at).alias("pos"), F.lit(rule.lo).alias("lo"), F.lit(rule.hi).alias("hi")
            ),
        )
        for at, rule in enumerate(rules)
    ]
    return F.array_compact(F.array(*marked)).cast(schema)


def match_rules(
    fields: DataFrame,
    rules: Sequence[DeclaredRule],
    non_numeric: Sequence[Sequence[str]] = (),
    *,
    fold_case: bool = True,
) -> DataFrame:
    """``fields`` with ``forced`` (declared non-numeric) and ``hits`` (matching range rules).

    Works on the field list, never on values: the rules are a handful of literals in the plan.
    """
    forced = F.lit(False)
    for contains in non_numeric:
        forced = forced | texts_occur(F.col("field"), contains, fold_case)
    return fields.select(
        "*", forced.alias("forced"), _hits(F.col("field"), rules, fold_case).alias("hits")
    )


def declare_violations(
    fields: DataFrame,
    rules: Sequence[DeclaredRule],
    non_numeric: Sequence[Sequence[str]] = (),
    *,
    fold_case: bool = True,
) -> DataFrame:
    """(model, field, kind, hits) for fields without exactly one meaning."""
    matched = match_rules(fields, rules, non_numeric, fold_case=fold_case)
    count = F.size("hits")
    kind = (
        F.when(F.col("forced") & (count > 0), "non_numeric_collision")
        .when(F.col("forced"), None)
        .when(count == 0, "missing_rule")
        .when(count > 1, "multiple_rules")
    )
    return (
        matched.select(
            "model", "field", kind.alias("kind"), F.transform("hits", lambda h: h["pos"]).alias("hits")
        )
    ).filter(F.col("kind").isNotNull())


def declare_ranges(
    fields: DataFrame,
    rules: Sequence[DeclaredRule],
    non_numeric: Sequence[Sequence[str]] = (),
    *,
    fold_case: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Declared range per (model, field); violating fields are left out, or an error if strict."""
    matched = match_rules(fields, rules, non_numeric, fold_case=fold_case)
    count = F.size("hits")
    good = F.when(F.col("forced"), count == 0).otherwise(count == 1)
    if strict:
        message = F.concat(F.lit("no single rule for "), "model", F.lit(" "), "field")
        matched = matched.withColumn("_ok", F.when(good, True).otherwise(F.raise_error(message)))
    else:
        matched = matched.withColumn("_ok", good)
    rule = F.get("hits", 0)
    return matched.filter("_ok").select(
        "model",
        F.lit("full").alias("variant"),
        "field",
        rule["lo"].alias("lo"),
        rule["hi"].alias("hi"),
        F.col("forced").alias("is_non_numeric"),
        (F.col("is_bool") if "is_bool" in fields.columns else F.lit(False)).alias("is_bool"),
    )


def rule_table_problems(rules: DataFrame) -> DataFrame:
    """(pos, problem) for declared rules held as a table.

    Columns: pos, contains ARRAY<STRING>, models ARRAY<STRING>, ends ARRAY<DOUBLE> and the four
    clamp columns, each NULL where not given.
    """
    lo, hi = F.get("ends", 0), F.get("ends", 1)
    pair = F.coalesce(F.size("ends") == 2, F.lit(False))
    both = lo.isNotNull() & hi.isNotNull()
    usable = (~F.isnan(lo)) & (F.abs(lo) != float("inf")) & (~F.isnan(hi)) & (
        F.abs(hi) != float("inf")
    )
    clamp = F.lit(False)
    for name in sorted(_CLAMP_KEYS):
        clamp = clamp | F.col(name).isNotNull()
    checks = {
        "names models": F.col("models").isNotNull(),
        "no contains": F.col("contains").isNull(),
        "has clamp keys": clamp,
        "no range": F.col("ends").isNull(),
        "range is not a pair": F.col("ends").isNotNull() & ~pair,
        "range holds null": pair & ~both,
        "range is not finite": pair & both & ~usable,
        "lo above hi": pair & both & usable & (lo > hi),
    }
    found = F.array_compact(F.array(*[F.when(c, name) for name, c in checks.items()]))
    return rules.select("pos", F.explode(found).alias("problem"))
