"""Drill-down queries over the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldguard.functions import labels
from fieldguard.functions.numeric import parse_number
from fieldguard.operators.order_stats import CHUNK_ROWS, row_numbers
from fieldguard.session import small_side

PAGE_SIZE = 9
# Days before the coming midnight at which each window starts (fixed values).
WINDOW_DAYS = {"7d": 8, "30d": 31, "90d": 91}
TIME_GROUPS = ("day", "week", "month")


def list_models(fields: DataFrame) -> DataFrame:
    return fields.select("model").distinct().orderBy("model")


def list_rule_codes(fields: DataFrame) -> DataFrame:
    codes = fields.filter(F.col("rule_code").isNotNull() & (F.col("rule_code") != ""))
    return codes.select("model", "rule_code").distinct().orderBy("model", "rule_code")


def fields_of_rule(fields: DataFrame, model: str, rule_code: str) -> DataFrame:
    chosen = fields.filter((F.col("model") == model) & (F.col("rule_code") == rule_code))
    return chosen.select("field_id", "field", "field_name", "type").orderBy("field")


def with_display_name(fields: DataFrame) -> DataFrame:
    return fields.withColumn(
        "display_name", labels.shown_name(F.col("field_name"), F.col("field"))
    )


def search_field(fields: DataFrame, model: str, text: str) -> DataFrame:
    """Exact match of the selector (surrounding blanks ignored); a blank search finds nothing."""
    text = text.strip()
    hit = (F.col("model") == model) & (F.col("field") == text) & F.lit(bool(text))
    return with_display_name(fields.filter(hit))


def threshold_lookup(fields: DataFrame, base: DataFrame, full: DataFrame) -> DataFrame:
    """Base and full bounds of every field as numbers.

    If either bound of a variant is text, both are NULL. ``has_threshold`` is FALSE for fields
    without a readable row in either table.
    """
    out = fields.select("model", "field_id", "field")
    for name, table in (("base", base), ("full", full)):
        lo, hi = parse_number(F.col("min")), parse_number(F.col("max"))
        readable = (F.col("min").isNull() | lo.isNotNull()) & (
            F.col("max").isNull() | hi.isNotNull()
        )
        bounds = table.select(
            "model",
            "field",
            readable.alias(f"_{name}"),
            F.when(readable, lo).alias(f"{name}_lo"),
            F.when(readable, hi).alias(f"{name}_hi"),
        )
        out = out.join(bounds, ["model", "field"], "left")
    known = F.coalesce("_base", F.lit(False)) | F.coalesce("_full", F.lit(False))
    return out.withColumn("has_threshold", known).drop("_base", "_full")


def relative_window(
    kind: str, as_of: date, recent_days: int | None = None
) -> tuple[str, str] | None:
    """[start, end) ending at the midnight after ``as_of``; None means no limit."""
    end = as_of + timedelta(days=1)
    if kind == "all":
        days = recent_days + 1 if recent_days and recent_days > 0 else None
    else:
        days = WINDOW_DAYS.get(kind)
    if days is None:
        return None
    return (end - timedelta(days=days)).isoformat(), end.isoformat()


def in_window(collected_at: Column, window: tuple[str, str] | None) -> Column:
    """Is the time inside the half-open window? Unreadable times only pass without a window."""
    if window is None:
        return F.lit(True)
    when = labels.utc_time(collected_at)
    start, end = (F.lit(edge).cast("timestamp_ntz") for edge in window)
    return (when >= start) & (when < end)


def field_data(
    fact: DataFrame,
    episodes: DataFrame,
    field_ids: Sequence[int] | None = None,
    model: str | None = None,
    window: tuple[str, str] | None = None,
    *,
    ordered: bool = False,
) -> DataFrame:
    """Values of some fields with their episode attributes.

    Both sides are cut down before they meet: model and fields reach the scan of the fact table,
    the time window that of the episodes. Sorting the whole result is left to the caller's choice.
    """
    if model is not None:
        fact = fact.filter(F.col("model") == model)
        episodes = episodes.filter(F.col("model") == model)
    if field_ids is not None:
        fact = fact.filter(F.col("field_id").isin(*field_ids))
    if window is not None:
        episodes = episodes.filter(in_window(F.col("collected_at"), window))
    attributes = episodes.select("model", "episode_id", "sn", "taskid", "area", "collected_at")
    rows = fact.join(attributes, ["model", "episode_id"])
    return rows.orderBy("collected_at", "field_id") if ordered else rows


def exclude_areas(rows: DataFrame, areas: Sequence[str]) -> DataFrame:
    """Leave out some areas; rows without an area stay."""
    if not areas:
        return rows
    return rows.filter(F.coalesce(~F.col("area").isin(*areas), F.lit(True)))


def only_episodes(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    keys = ["model", "episode_id"]
    return rows.join(chosen.select(*keys).distinct(), keys, "left_semi")


def stratified_sample(
    episodes: DataFrame, percent: float | None, seed: str = "", *, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Per task, the max(1, floor(n * percent / 100)) episodes with the smallest seeded md5.

    The exact quota also holds for a task with a third of all episodes: its hashes are ranked in
    chunks, not in one window.
    """
    rows = episodes.select("model", "taskid", "episode_id").distinct()
    if not percent or percent >= 100:
        return rows
    keyed = rows.withColumn("_hash", F.md5(F.concat(F.lit(seed), F.col("episode_id"))))
    ranked = row_numbers(
        keyed, ["model", "taskid"], ["_hash", "episode_id"], "_rank", chunk_rows=chunk_rows,
        total="_n",
    )
    quota = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(percent / 100.0)))
    return ranked.filter(F.col("_rank") <= quota).select("model", "taskid", "episode_id")


def plot_values(rows: DataFrame, fields: DataFrame) -> DataFrame:
    """Add ``value_num`` and the field's type.

    Numbers are numbers or NULL; non-numeric cells are 1.0 where missing and 0.0 where present.
    """
    kinds = small_side(fields.select("model", "field_id", "type"))
    raw = F.col("value")
    missing = raw.isNull() | F.lower(F.trim(raw)).isin("", "n/a", "null", "nan")
    number = F.when(
        F.col("type") == "non_numeric", F.when(missing, 1.0).otherwise(0.0)
    ).otherwise(parse_number(raw))
    return rows.join(kinds, ["model", "field_id"], "left").withColumn(
        "value_num", F.when(F.col("type").isNotNull(), number)
    )


def series(rows: DataFrame) -> DataFrame:
    """The rows that can be drawn."""
    return rows.filter(F.col("value_num").isNotNull())


def _sort_keys(sort_by: str, group_by: str) -> list[str]:
    keys = [sort_by if sort_by in ("sn", "taskid", "area") else "collected_at"]
    if group_by in ("sn", "taskid", "area") and group_by not in keys:
        keys.append(group_by)
    if "collected_at" not in keys:
        keys.append("collected_at")
    return keys


def with_time(rows: DataFrame) -> DataFrame:
    """Add ``_time``, by which axes sort instead of by the text of the time."""
    return rows.withColumn("_time", labels.utc_time(F.col("collected_at")))


def _timed(rows: DataFrame, sort_by: str, group_by: str) -> tuple[DataFrame, list[str]]:
    """The rows with ``_time`` (as it is, if they have it), and the columns that order an axis."""
    timed = rows if "_time" in rows.columns else with_time(rows)
    order = ["_time" if k == "collected_at" else k for k in _sort_keys(sort_by, group_by)]
    return timed, [*order, "episode_id"]


def model_axis(
    rows: DataFrame, sort_by: str = "sn", group_by: str = "sn", *, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """(model, episode_id, episode_index): place of every episode over all fields of its model, in chunks."""
    timed, order = _timed(rows, sort_by, group_by)
    axis = timed.select("model", *order).distinct()
    axis = row_numbers(axis, ["model"], order, "episode_index", chunk_rows=chunk_rows)
    return axis.select("model", "episode_id", "episode_index")


def episode_index(
    rows: DataFrame,
    sort_by: str = "sn",
    group_by: str = "sn",
    *,
    per_field: bool = True,
    chunk_rows: int = CHUNK_ROWS,
    settled: bool = False,
) -> DataFrame:
    """1-based place of every episode on the x axis, per field or over all fields of a model.

    Ties are broken by episode id. Times sort as times, unreadable ones last. The axis of a whole
    model is numbered in chunks. ``settled`` rows (with ``_time``) are not written again.
    """
    if per_field:
        timed, order = _timed(rows, sort_by, group_by)
        out = row_numbers(
            timed, ["model", "field_id"], order, "episode_index", chunk_rows=chunk_rows, settled=settled
        )
        return out.drop("_time")
    placed = model_axis(rows, sort_by, group_by, chunk_rows=chunk_rows)
    return rows.join(placed, ["model", "episode_id"], "left")


def with_group(rows: DataFrame, group_by: str = "sn", name: str = "group_key") -> DataFrame:
    label = labels.group_label(
        group_by, F.col("area"), F.col("sn"), F.col("taskid"), F.col("collected_at")
    )
    return rows.withColumn(name, label)


def group_stats(
    rows: DataFrame, fields: DataFrame, thresholds: DataFrame, group_by: str = "sn"
) -> DataFrame:
    """mean, pass/fail against the base bounds and missing cells per field and group.

    Rates are percentages. Numeric fields: missing counts NULL cells over all rows, pass and fail
    count valid numbers only (text is neither). Non-numeric fields: present cells pass.
    """
    bounds = small_side(thresholds.select("model", "field_id", "base_lo", "base_hi"))
    judged = with_group(plot_values(rows, fields), group_by).join(
        bounds, ["model", "field_id"], "left"
    )
    x = F.col("value_num")
    text_field = F.col("type") == "non_numeric"
    inside = (x >= F.col("base_lo")) & (x <= F.col("base_hi"))
    stats = judged.groupBy("model", "field_id", "group_key").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.first("type").alias("_type"),
        F.avg(x).alias("_mean"),
        F.count(x).alias("_valid"),
        F.count_if(inside).alias("_inside"),
        F.max(F.col("base_lo").isNotNull() & F.col("base_hi").isNotNull()).alias("_bounded"),
        F.count_if(F.when(text_field, x == 1.0).otherwise(F.col("value").isNull())).alias(
            "missing_count"
        ),
        F.count_if(text_field & (x == 0.0)).alias("_present"),
    )
    is_text = F.coalesce(F.col("_type") == "non_numeric", F.lit(False))
    tested = F.col("_bounded") & (F.col("_valid") > 0)
    return stats.select(
        "model",
        "field_id",
        "group_key",
        F.when(~is_text, F.col("_mean")).alias("mean"),
        F.when(is_text, F.col("_present") / F.col("_rows") * 100)
        .when(tested, F.col("_inside") / F.col("_valid") * 100)
        .alias("pass_rate"),
        F.when(is_text, F.col("_present"))
        .when(tested, F.col("_inside"))
        .otherwise(F.lit(0))
        .alias("pass_count"),
        F.when(~is_text & tested, F.col("_valid") - F.col("_inside"))
        .otherwise(F.lit(0))
        .alias("fail_count"),
        "missing_count",
        (F.col("missing_count") / F.col("_rows") * 100).alias("missing_rate"),
    )


def legend(rows: DataFrame, group_by: str = "sn") -> DataFrame:
    """Groups in the order in which they first appear on the axis (needs ``episode_index``)."""
    firsts = (
        with_group(rows, group_by)
        .groupBy("model", "group_key")
        .agg(F.min("episode_index").alias("first_index"))
    )
    return row_numbers(firsts, ["model"], ["first_index", "group_key"], "place")


def threshold_segments(rows: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Per field, the stretch of the axis it covers and the bounds to draw there."""
    spans = rows.groupBy("model", "field_id").agg(
        F.min("episode_index").alias("first_index"), F.max("episode_index").alias("last_index")
    )
    bounds = thresholds.filter("has_threshold").drop("field", "has_threshold")
    return spans.join(bounds, ["model", "field_id"])


def page_fields(fields: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Number the fields of every rule code and put them on pages."""
    rule = Window.partitionBy("model", "rule_code")
    place = F.row_number().over(rule.orderBy("field"))
    pages = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)).over(rule) / page_size))
    return fields.select(
        "*",
        place.alias("place"),
        F.ceil(place / page_size).cast("bigint").alias("page"),
        pages.cast("bigint").alias("pages"),
    )


def page(fields: DataFrame, model: str, rule_code: str, number: int) -> DataFrame:
    """One page of fields; numbers beyond either end give the nearest page."""
    chosen = fields.filter((F.col("model") == model) & (F.col("rule_code") == rule_code))
    paged = page_fields(chosen)
    return paged.filter(
        F.col("page") == F.least(F.greatest(F.lit(number), F.lit(1)), F.col("pages"))
    )


def episode_detail(episodes: DataFrame, model: str, episode_id: str) -> DataFrame:
    return episodes.filter((F.col("model") == model) & (F.col("episode_id") == episode_id))
