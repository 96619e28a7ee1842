"""Which fields exist: sampling, filtering, union and consistency of field sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldguard.operators.flatten import flatten_any
from fieldguard.operators.order_stats import first_rows
from fieldguard.session import small_side


@dataclass(frozen=True)
class BlockRule:
    contains: Sequence[str]
    models: Sequence[str] = field(default_factory=tuple)


@dataclass(frozen=True)
class FieldFilter:
    """Allow lists, block rules and how to match them."""

    tokens: Sequence[str] = ()
    token_mode: str = "exact"  # or "contains"
    use_tokens: bool = True
    sequences: Sequence[Sequence[str]] = ()
    sequence_mode: str = "both"  # or "ordered", "adjacent"
    case_sensitive: bool = True
    use_sequences: bool = True
    block: Sequence[BlockRule] = ()
    use_block: bool = True
    allow_all_if_empty: bool = True


def tokens_allowed(selector: Column, tokens: Sequence[str], mode: str = "exact") -> Column:
    """Does an angle token equal (or, in contains mode, hold) one of the listed words?"""
    if not tokens:
        return F.lit(False)
    if mode == "contains":
        # A word inside a token is a word inside the selector.
        hit = F.lit(False)
        for word in tokens:
            hit = hit | selector.contains(word)
        return hit
    found = F.regexp_extract_all(selector, F.lit(r"<([^<>]+)>"), F.lit(1))
    return F.arrays_overlap(found, F.array(*[F.lit(t) for t in tokens]))


def sequences_allowed(
    selector: Column,
    sequences: Sequence[Sequence[str]],
    mode: str = "both",
    case_sensitive: bool = True,
) -> Column:
    """Do all texts of one list occur (anywhere, in order, or back to back)?"""
    hay = selector if case_sensitive else F.lower(selector)
    hit = F.lit(False)
    for texts in sequences:
        if not texts:
            continue
        parts = list(texts) if case_sensitive else [t.lower() for t in texts]
        if mode == "adjacent":
            one = hay.contains("".join(parts))
        elif mode == "ordered":
            quoted = [r"\Q" + p.replace("\\E", "\\E\\\\E\\Q") + r"\E" for p in parts]
            one = hay.rlike("(?s)" + ".*".join(quoted))
        else:
            one = F.lit(True)
            for p in parts:
                one = one & hay.contains(p)
        hit = hit | one
    return hit


def blocked(selector: Column, model: Column, rules: Sequence[BlockRule]) -> Column:
    """Does a rule for this model (or for all) find all its texts? Empty rules are ignored."""
    hit = F.lit(False)
    for rule in rules:
        if not rule.contains:
            continue
        one = F.lit(True)
        for text in rule.contains:
            one = one & selector.contains(str(text))
        if rule.models:
            one = one & F.lower(model).isin(*[str(m).lower() for m in rule.models])
        hit = hit | one
    return hit


def keeps(selector: Column, model: Column, rules: FieldFilter) -> Column:
    """The whole filter. A list that is switched off but not empty still turns "allow all" off."""
    if not rules.tokens and not rules.sequences:
        allowed = F.lit(rules.allow_all_if_empty)
    else:
        allowed = F.lit(False)
        if rules.use_tokens:
            allowed = allowed | tokens_allowed(selector, rules.tokens, rules.token_mode)
        if rules.use_sequences:
            allowed = allowed | sequences_allowed(
                selector, rules.sequences, rules.sequence_mode, rules.case_sensitive
            )
    if rules.use_block:
        allowed = allowed & ~blocked(selector, model, rules.block)
    return allowed


def filter_fields(fields: DataFrame, rules: FieldFilter) -> DataFrame:
    """``fields`` (with model and field) cut down to those the filter keeps."""
    return fields.filter(keeps(F.col("field"), F.col("model"), rules))


def sample_reports(reports: DataFrame, keys: Sequence[str] = ("model", "taskid")) -> DataFrame:
    """One report per group: the smallest path, ``*_collect.json`` preferred.

    The choice is made on paths alone; only then are the chosen documents fetched by path. So a
    huge group costs one small aggregate, not a shuffle of its documents.
    """
    order = F.struct(~F.col("path").endswith("_collect.json"), F.col("path"))
    chosen = reports.groupBy(*keys).agg(F.min_by("path", order).alias("path"))
    return reports.join(small_side(chosen.select("path")), "path", "left_semi")


def task_fields(samples: DataFrame, rules: FieldFilter | None = None) -> DataFrame:
    """(model, taskid, field) found in the sampled reports after filtering."""
    found = flatten_any(samples, ("model", "taskid")).select("model", "taskid", "field").distinct()
    return filter_fields(found, rules) if rules else found


def readable_tasks(samples: DataFrame) -> DataFrame:
    """(model, taskid) of samples that yield any field at all, before filtering."""
    return flatten_any(samples, ("model", "taskid")).select("model", "taskid").distinct()


def union_fields(
    samples: DataFrame,
    rules: FieldFilter | None = None,
    *,
    min_ratio: float | None = None,
    ratio_by_model: Mapping[str, float] | None = None,
) -> DataFrame:
    """Fields of all tasks of a model, with the number of tasks that have them.

    With ``min_ratio``, fields present in too small a share of the readable tasks are dropped;
    ``ratio_by_model`` overrides the ratio for single models.
    """
    per_task = flatten_any(samples, ("model", "taskid")).select("model", "taskid", "field").distinct()
    tasks = per_task.select("model", "taskid").distinct().groupBy("model")
    tasks = tasks.agg(F.count(F.lit(1)).alias("tasks"))
    kept = filter_fields(per_task, rules) if rules else per_task
    counted = kept.groupBy("model", "field").agg(F.count(F.lit(1)).alias("tasks_with_field"))
    out = counted.join(tasks, "model")
    if min_ratio is None:
        return out
    needed = F.lit(float(min_ratio))
    for model, ratio in (ratio_by_model or {}).items():
        needed = F.when(F.col("model") == model, F.lit(float(ratio))).otherwise(needed)
    return out.filter(F.col("tasks_with_field") / F.col("tasks") >= needed)


def pick_tasks(tasks: DataFrame, count: int | None, seed: str = "0") -> DataFrame:
    """Seeded choice of tasks per model: smallest md5 first; None takes all."""
    tasks = tasks.select("model", "taskid").distinct()
    if count is None:
        return tasks
    keyed = tasks.withColumn("_hash", F.md5(F.concat(F.lit(seed), "taskid")))
    return first_rows(keyed, ["model"], ["_hash", "taskid"], count).select("model", "taskid")


def field_set_diff(per_task: DataFrame, base: DataFrame, preview: int | None = 5) -> DataFrame:
    """Differences between the base field set of a model and the set of each of its tasks.

    (model, taskid, side, field, place): ``side`` is ``base`` or ``sample``, whichever has the
    field alone. ``preview`` limits the listed fields per task and side, in field order.
    """
    # A set holds the fields of one report, so gathering it is bounded; comparing sets keeps
    # everything at one row per task.
    wanted = base.groupBy("model").agg(F.collect_set("field").alias("_base"))
    found = per_task.groupBy("model", "taskid").agg(F.collect_set("field").alias("_own"))
    sides = F.array(
        F.struct(F.lit("base").alias("side"), F.array_except("_base", "_own").alias("fields")),
        F.struct(F.lit("sample").alias("side"), F.array_except("_own", "_base").alias("fields")),
    )
    both = found.join(wanted, "model").select("model", "taskid", F.inline(sides))
    listed = F.sort_array("fields")
    if preview is not None:
        listed = F.slice(listed, 1, preview)
    diff = both.select("model", "taskid", "side", F.posexplode(listed).alias("_at", "field"))
    return diff.select("model", "taskid", "side", "field", (F.col("_at") + 1).alias("place"))


def require_consistent(diff: DataFrame) -> None:
    """Raise on the first difference."""
    first = diff.orderBy("model", "taskid", "side", "field").limit(1).collect()
    if first:
        raise RuntimeError(f"field sets differ: {first[0].asDict()}")


def clean_field_list(lines: DataFrame) -> DataFrame:
    """(model, pos, line) to (model, pos, field): trimmed, unquoted, comments dropped, deduplicated.

    The first position of a field counts.
    """
    text = F.trim(F.col("line"))
    text = F.when(~text.startswith("#"), text)
    text = F.rtrim(F.regexp_replace(text, r",$", ""))
    text = F.regexp_replace(text, r"""^(["'])(.*)\1$""", "$2")
    text = F.trim(F.replace(text, F.lit('\\"'), F.lit('"')))
    cleaned = lines.select("model", "pos", text.alias("field")).filter("field != ''")
    return cleaned.groupBy("model", "field").agg(F.min("pos").alias("pos"))
