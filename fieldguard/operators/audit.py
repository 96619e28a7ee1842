"""Testing values against ranges: per field, per episode, per model.

``values`` is the long table (model, episode_id, field, value), one row per episode and extracted
field. ``ranges`` holds a few rows per field; it is broadcast after a check of its size, so the
long table is read once and only partial counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldguard.functions.numeric import (
    NA_TOKENS,
    bool_number,
    has_content,
    parse_number,
    present,
)
from fieldguard.operators.order_stats import first_rows
from fieldguard.session import settle, small_side

FIELD = ("model", "variant", "field")
EPISODE = ("model", "variant", "episode_id")


@dataclass(frozen=True)
class AuditParams:
    treat_nan_as_fail: bool = True
    fields_mode: str = "range_only"  # or "values_only"
    missing_value_col_is_fail: bool = True
    missing_range_is_fail: bool = False
    na_tokens: Sequence[str] = NA_TOKENS


def _ranges(ranges: DataFrame) -> DataFrame:
    bool_flag = F.col("is_bool") if "is_bool" in ranges.columns else F.lit(False)
    return ranges.select(
        *FIELD, "lo", "hi", "is_non_numeric", F.coalesce(bool_flag, F.lit(False)).alias("is_bool")
    )


def judge(
    values: DataFrame, ranges: DataFrame, p: AuditParams | None = None, *, how: str = "inner"
) -> DataFrame:
    """Every value with its range and the verdict, one row per value and range variant.

    ``ok`` is TRUE (pass), FALSE (fail) or NULL (not counted); ``reason`` says why a value fails.
    Values of fields without a range are dropped (or, with ``how="left"``, kept unjudged).
    """
    p = p or AuditParams()
    joined = values.join(ranges, ["model", "field"], how)
    cell = present(F.col("value"), p.na_tokens)
    number = F.coalesce(parse_number(cell), F.when(F.col("is_bool"), bool_number(cell)))
    return _verdict(joined.withColumn("x", number), p)


def _verdict(joined: DataFrame, p: AuditParams) -> DataFrame:
    x, lo, hi = F.col("x"), F.col("lo"), F.col("hi")
    filled = has_content(F.col("value"), p.na_tokens)
    bounded = lo.isNotNull() & hi.isNotNull()
    inside = (x >= lo) & (x <= hi)
    numeric_ok = (
        F.when(~bounded, False)
        .when(x.isNull(), False if p.treat_nan_as_fail else None)
        .otherwise(inside)
    )
    reason = (
        F.when(F.col("is_non_numeric"), F.when(~filled, "empty"))
        .when(~bounded, "no_bounds")
        .when(x.isNull(), "nan" if p.treat_nan_as_fail else None)
        .when(~inside, "out_of_range")
    )
    return joined.select(
        "*",
        F.when(F.col("is_non_numeric"), filled).otherwise(numeric_ok).alias("ok"),
        reason.alias("reason"),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _episode_counts(episodes: DataFrame) -> DataFrame:
    return episodes.groupBy("model").agg(F.count(F.lit(1)).alias("_episodes"))


def audit_fields(
    values: DataFrame,
    ranges: DataFrame,
    episodes: DataFrame,
    params: AuditParams | None = None,
) -> DataFrame:
    """pass_count, fail_count, pass_rate of every field in scope.

    ``episodes`` (one row per episode) gives the counts for ranges whose field was never extracted
    and for extracted fields without a range. ``values`` may be counted ones (``extract.count_cells``).
    """
    p = params or AuditParams()
    side = small_side(_ranges(ranges))
    only_values = p.fields_mode == "values_only"

    def number(condition: Column) -> Column:
        if "_count" not in values.columns:
            return F.count_if(condition)
        return F.sum(F.when(condition, F.col("_count")).otherwise(0))

    counted = (
        judge(values, side, p, how="left" if only_values else "inner")
        .groupBy(*FIELD)
        .agg(number(F.col("ok")).alias("pass_count"), number(~F.col("ok")).alias("fail_count"))
    )
    if only_values and p.missing_range_is_fail:
        # A handful of rows per field from here on.
        counted = settle(counted)
        scored = counted.filter(F.col("variant").isNotNull()).unionByName(
            _all_failed(_without_range(counted, side), episodes)
        )
    elif only_values:
        scored = counted.filter(F.col("variant").isNotNull())
    elif p.missing_value_col_is_fail:
        scored = (
            side.select(*FIELD)
            .join(counted, list(FIELD), "left")
            .join(_episode_counts(episodes), "model", "left")
            .select(
                *FIELD,
                F.coalesce("pass_count", F.lit(0)).alias("pass_count"),
                F.coalesce("fail_count", "_episodes", F.lit(0)).alias("fail_count"),
            )
        )
    else:
        scored = counted
    total = F.col("pass_count") + F.col("fail_count")
    return scored.select(
        *FIELD, "pass_count", "fail_count", _share(F.col("pass_count"), total).alias("pass_rate")
    )


def _without_range(extracted: DataFrame, ranges: DataFrame) -> DataFrame:
    """(model, variant, field) of extracted fields that a variant has no range for."""
    fields = extracted.select("model", "field").distinct()
    variants = ranges.select("model", "variant").distinct()
    return (
        fields.join(variants, "model")
        .join(ranges.select(*FIELD), list(FIELD), "left_anti")
        .select(*FIELD)
    )


def _all_failed(fields: DataFrame, episodes: DataFrame) -> DataFrame:
    return fields.join(_episode_counts(episodes), "model").select(
        *FIELD,
        F.lit(0).cast("bigint").alias("pass_count"),
        F.col("_episodes").alias("fail_count"),
    )


def with_stats(ranges: DataFrame, stats: DataFrame) -> DataFrame:
    """The ranges table with its statistics columns (NULL where a field was not tested)."""
    old = [c for c in ("pass_count", "fail_count", "pass_rate") if c in ranges.columns]
    return ranges.drop(*old).join(stats, list(FIELD), "left")


def _top(df: DataFrame, group: Sequence[str], fails: str, tie: str, n: int) -> DataFrame:
    """First n rows per group by most failures, lowest rate, then name."""
    keyed = df.withColumn("_passing_order", -F.col(fails))
    top = first_rows(keyed, group, ["_passing_order", "pass_rate", tie], n)
    return top.drop("_passing_order")


def top_failing_fields(stats: DataFrame, n: int = 5) -> DataFrame:
    return _top(stats, ["model", "variant"], "fail_count", "field", n)


def top_failing_episodes(scorecard: DataFrame, n: int = 10) -> DataFrame:
    return _top(scorecard, ["model", "variant"], "fail_fields", "episode_id", n)


def fail_details(
    values: DataFrame,
    ranges: DataFrame,
    k: int = 1,
    params: AuditParams | None = None,
    *,
    extracted: DataFrame | None = None,
) -> DataFrame:
    """First k failing episodes of every field, with the reason; all of them if k is 0.

    A range whose field was never extracted gives one row for all episodes. ``extracted`` is the
    (model, field) list of the values, if known; otherwise it is read off them.
    """
    p = params or AuditParams()
    side = small_side(_ranges(ranges))
    failed = judge(values, side, p).filter(~F.col("ok") & (F.col("reason") != "no_bounds"))
    if k > 0:
        failed = first_rows(failed, FIELD, ["episode_id"], k)
    columns = [*FIELD, "episode_id", "reason", "x", "lo", "hi"]
    details = failed.select(*columns)
    if not p.missing_value_col_is_fail or p.fields_mode == "values_only":
        return details
    absent = side.join(_fields_of(values, extracted), ["model", "field"], "left_anti").select(
        *FIELD,
        F.lit("<all>").alias("episode_id"),
        F.lit("missing_value_column").alias("reason"),
        F.lit(None).cast("double").alias("x"),
        "lo",
        "hi",
    )
    return details.unionByName(absent)


def _fields_of(values: DataFrame, extracted: DataFrame | None) -> DataFrame:
    return (values if extracted is None else extracted).select("model", "field").distinct()


def _absent_counts(extracted: DataFrame, side: DataFrame) -> DataFrame:
    """Per (model, variant): number of ranges whose field was never extracted."""
    absent = side.join(extracted, ["model", "field"], "left_anti")
    return absent.groupBy("model", "variant").agg(F.count(F.lit(1)).alias("_absent"))


def episode_scorecard(
    values: DataFrame,
    ranges: DataFrame,
    params: AuditParams | None = None,
    *,
    extracted: DataFrame | None = None,
) -> DataFrame:
    """total, passed and failed fields of every episode.

    All rows of an episode leave extraction together, so they collapse to one row per episode
    before the shuffle.
    """
    p = params or AuditParams()
    side = small_side(_ranges(ranges))
    card = (
        judge(values, side, p)
        .groupBy(*EPISODE)
        .agg(
            F.count("ok").alias("total_fields"),
            F.count_if("ok").alias("pass_fields"),
        )
    )
    if p.fields_mode != "values_only":
        absent = _absent_counts(_fields_of(values, extracted), side)
        card = card.join(small_side(absent), ["model", "variant"], "left").withColumn(
            "total_fields", F.col("total_fields") + F.coalesce("_absent", F.lit(0))
        )
    return card.select(
        *EPISODE,
        "total_fields",
        "pass_fields",
        (F.col("total_fields") - F.col("pass_fields")).alias("fail_fields"),
        _share(F.col("pass_fields"), F.col("total_fields")).alias("pass_rate"),
    )


def model_pass_rate(
    values: DataFrame,
    ranges: DataFrame,
    episodes: DataFrame,
    params: AuditParams | None = None,
    *,
    extracted: DataFrame | None = None,
) -> DataFrame:
    """Share of episodes in which every field in scope passes."""
    p = params or AuditParams()
    side = small_side(_ranges(ranges))
    good = F.coalesce(F.col("ok"), F.lit(True))
    clean = (
        judge(values, side, p)
        .groupBy(*EPISODE)
        .agg(F.bool_and(good).alias("_clean"))
        .groupBy("model", "variant")
        .agg(F.count_if("_clean").alias("pass_episodes"))
    )
    blocked = F.lit(False)
    rows = side.select("model", "variant").distinct().join(clean, ["model", "variant"], "left")
    if p.fields_mode != "values_only" and p.missing_value_col_is_fail:
        absent = _absent_counts(_fields_of(values, extracted), side)
        rows = rows.join(absent, ["model", "variant"], "left")
        blocked = blocked | F.col("_absent").isNotNull()
    if p.fields_mode == "values_only" and p.missing_range_is_fail:
        extra = _without_range(_fields_of(values, extracted), side)
        extra = extra.groupBy("model", "variant").agg(F.count(F.lit(1)).alias("_extra"))
        rows = rows.join(extra, ["model", "variant"], "left")
        blocked = blocked | F.col("_extra").isNotNull()
    rows = rows.join(_episode_counts(episodes), "model")
    passed = F.when(blocked, 0).otherwise(F.coalesce("pass_episodes", F.lit(0))).cast("bigint")
    return rows.select(
        "model",
        "variant",
        passed.alias("pass_episodes"),
        F.col("_episodes").alias("episodes"),
        _share(passed, F.col("_episodes")).alias("pass_rate"),
    )
