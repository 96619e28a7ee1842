"""Names and labels derived from selectors and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rule_code(field: Column) -> Column:
    """Value of the first ``[<ruleCode>=<...>]`` filter, empty if there is none."""
    return F.regexp_extract(field, r"\[<ruleCode>=<([^>]+)>\]", 1)


def _tokens(text: Column) -> Column:
    return F.array_join(F.regexp_extract_all(text, F.lit(r"<([^>]+)>"), F.lit(1)), "-")


def _after(field: Column, marker: str) -> Column:
    """Text behind the first occurrence of ``marker`` (NULL if absent)."""
    at = F.instr(field, marker)
    return F.when(at > 0, F.substring(field, at + len(marker), F.length(field)))


def display_name(field: Column) -> Column:
    """Short name: the tokens below the metadata section, or ``<last name>-<last key>``."""
    metadata = F.coalesce(
        _after(field, ".<camera_info>"),
        _after(field, ".<joint_info>"),
        _after(field, ".<metadata>"),
        _after(field, "[<name>=<metadata.json>]"),
    )
    last_name = F.try_element_at(
        F.regexp_extract_all(field, F.lit(r"\[<name>=<([^>]+)>\]"), F.lit(1)), F.lit(-1)
    )
    last_key = F.try_element_at(
        F.regexp_extract_all(field, F.lit(r"\.<([^>]+)>"), F.lit(1)), F.lit(-1)
    )
    return F.when(
        rule_code(field) == "metadata_raw", F.coalesce(_tokens(metadata), F.lit(""))
    ).otherwise(F.concat_ws("-", last_name, last_key))


def shown_name(field_name: Column, field: Column) -> Column:
    """The display name, or the selector itself when that is blank."""
    return F.coalesce(F.when(F.trim(field_name) != "", field_name), field)


def week_label(ts: Column) -> Column:
    """``YYYY-Www``, Monday first, days before the first Monday in week 00."""
    week = F.floor((F.dayofyear(ts) + 6 - F.weekday(ts)) / 7)
    return F.concat(F.date_format(ts, "yyyy"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def utc_time(text: Column) -> Column:
    """UTC wall time (without zone) of an ISO text, NULL if it is not one.

    Texts without an offset are taken as UTC; the session's time zone plays no part.
    """
    day = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$"
    zoned = r"(?i)(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2})?)\s*$"
    trimmed = F.trim(text)
    full = (
        F.when(trimmed.rlike(day), F.concat(trimmed, F.lit(" 00:00:00Z")))
        .when(trimmed.rlike(r"[0-9]:[0-9]") & ~trimmed.rlike(r":[0-9.]+" + zoned), F.concat(trimmed, F.lit("Z")))
        .otherwise(trimmed)
    )
    seconds = (F.unix_micros(F.try_to_timestamp(full)) / 1_000_000).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def group_label(
    by: str, area: Column, sn: Column, taskid: Column, collected_at: Column
) -> Column:
    """Grouping label of an episode; unknown groupings fall back to ``area: sn``."""
    missing = F.lit("N/A")
    when = utc_time(collected_at)
    if by == "taskid":
        return F.coalesce(taskid, missing)
    if by == "area":
        return F.coalesce(area, missing)
    if by == "day":
        return F.coalesce(F.date_format(when, "yyyy-MM-dd"), missing)
    if by == "week":
        return F.coalesce(week_label(when), missing)
    if by == "month":
        return F.coalesce(F.date_format(when, "yyyy-MM"), missing)
    return F.concat(F.coalesce(area, missing), F.lit(": "), F.coalesce(sn, missing))
