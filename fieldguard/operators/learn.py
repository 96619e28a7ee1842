"""Learning an acceptable range per (model, field) from the observed values."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldguard.functions import intervals as iv
from fieldguard.functions.numeric import NA_TOKENS, bool_number, parse_number, present
from fieldguard.operators import order_stats
from fieldguard.session import settle, small_side

GROUP = ("model", "field")
STAGES = ("sign", "expand", "region_adjust", "field")
# Standard deviation of a normal distribution per median absolute deviation (fixed value).
MAD_TO_SIGMA = 1.4826


@dataclass(frozen=True)
class TextRule:
    """Selects fields containing every given text, for some models or all."""

    contains: Sequence[str]
    models: Sequence[str] = field(default_factory=tuple)


@dataclass(frozen=True)
class LearnParams:
    method: str = "cover"
    iqr_k: float = 1.5
    mad_z: float = 3.0
    cover_pct: float = 0.95
    min_valid_count: int = 2
    clamp_to_observed: bool = True
    round_decimals: int | None = 6
    expand_pct: float = 1.0
    stages: Sequence[str] = STAGES
    sign_clamp: bool = True
    post_expand_sign_clamp: bool = True
    region_multiplier: float = 1.0
    region_adjust: bool = True
    non_numeric_rules: Sequence[TextRule] = ()
    bound_rules: Sequence[iv.BoundRule] = ()
    fold_case: bool = True
    fold_model_case: bool = True
    apply_all_rules: bool = True
    na_tokens: Sequence[str] = NA_TOKENS
    chunk_rows: int = order_stats.CHUNK_ROWS


def region_multiplier(multipliers: Mapping[str, float], area: str) -> float:
    """Widening factor of the area a run is made for (1.0 where none is declared)."""
    return float(multipliers.get(area, 1.0))


def check_stages(stages: Sequence[str]) -> tuple[str, ...]:
    """The stage order must name each of the four stages once."""
    if sorted(stages) != sorted(STAGES):
        raise ValueError(f"stages must be a permutation of {STAGES}, got {tuple(stages)}")
    return tuple(stages)


def is_forced_non_numeric(
    model: Column,
    name: Column,
    rules: Sequence[TextRule],
    *,
    fold_case: bool = True,
    fold_model_case: bool = True,
) -> Column:
    hit = F.lit(False)
    for rule in rules:
        hit = hit | (
            iv.texts_occur(name, rule.contains, fold_case)
            & iv.model_listed(model, rule.models, fold_model_case)
        )
    return hit


def numeric_values(values: DataFrame, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """``values`` with ``x``: the cell as DOUBLE, NULL where it is missing or not a number."""
    return values.withColumn("x", parse_number(present(F.col("value"), na_tokens)))


def observed(values: DataFrame, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Count, minimum and maximum of the numbers of every (model, field)."""
    return (
        numeric_values(values, na_tokens)
        .groupBy(*GROUP)
        .agg(
            F.count("x").alias("n"),
            F.min("x").alias("smallest"),
            F.max("x").alias("largest"),
        )
    )


def _counted(values: DataFrame, p: LearnParams) -> DataFrame:
    """(model, field, kind, x, _count): cells sorted into numbers, booleans, texts and gaps."""
    forced = is_forced_non_numeric(
        F.col("model"),
        F.col("field"),
        p.non_numeric_rules,
        fold_case=p.fold_case,
        fold_model_case=p.fold_model_case,
    )
    cell = present(F.col("value"), p.na_tokens)
    weight = ["_count"] if "_count" in values.columns else []
    typed = values.select(
        *GROUP,
        forced.alias("_forced"),
        cell.alias("_cell"),
        parse_number(cell).alias("_number"),
        bool_number(cell).alias("_bool"),
        *weight,
    )
    kind = (
        F.when(F.col("_forced"), "forced")
        .when(F.col("_number").isNotNull(), "number")
        .when(F.col("_bool").isNotNull(), "bool")
        .when(F.col("_cell").isNotNull(), "text")
        .otherwise("gap")
    )
    x = F.when(~F.col("_forced"), F.coalesce("_number", "_bool"))
    return order_stats.count_values(
        typed.select(*GROUP, kind.alias("kind"), x.alias("x"), *weight), [*GROUP, "kind"], "x"
    )


def _initial(counts: DataFrame, p: LearnParams) -> DataFrame:
    """n, smallest, largest, lo, hi per (model, field, kind) by the chosen method."""
    keys = [*GROUP, "kind"]
    lo, hi = F.col("lo"), F.col("hi")
    if p.method == "cover":
        if not math.isfinite(p.cover_pct):
            raise ValueError(f"cover_pct must be finite, got {p.cover_pct}")
        got = order_stats.shortest_cover(counts, keys, "x", p.cover_pct, chunk_rows=p.chunk_rows)
    elif p.method == "iqr":
        got = order_stats.quantiles(counts, keys, "x", [0.25, 0.75], chunk_rows=p.chunk_rows)
        spread = F.col("q1") - F.col("q0")
        usable = (spread != 0) & iv.finite(spread)
        lo = F.when(usable, F.col("q0") - F.lit(float(p.iqr_k)) * spread)
        hi = F.when(usable, F.col("q1") + F.lit(float(p.iqr_k)) * spread)
    elif p.method == "mad":
        mid = small_side(
            order_stats.quantiles(counts, keys, "x", [0.5], chunk_rows=p.chunk_rows)
        )
        # Distances need no counting anew: equal ones from both sides may come as two rows.
        apart = counts.alias("c").join(mid.alias("m"), order_stats._same("c", "m", keys))
        apart = apart.select(
            *[f"c.{k}" for k in keys], F.abs(F.col("c.x") - F.col("m.q0")).alias("x"), F.col("c._count").alias("_count")
        )
        mad = order_stats.quantiles(apart, keys, "x", [0.5], chunk_rows=p.chunk_rows)
        got = mid.withColumnRenamed("q0", "_median").join(
            mad.select(*keys, F.col("q0").alias("_mad")), keys
        )
        reach = F.lit(float(p.mad_z)) * (F.lit(MAD_TO_SIGMA) * F.col("_mad"))
        usable = (F.col("_mad") != 0) & iv.finite(F.col("_mad"))
        lo = F.when(usable, F.col("_median") - reach)
        hi = F.when(usable, F.col("_median") + reach)
    else:
        raise ValueError(f"unknown method: {p.method}")
    enough = F.col("n") >= p.min_valid_count
    return got.select(
        *keys,
        "n",
        "smallest",
        "largest",
        F.coalesce(F.when(enough, lo), F.col("smallest")).alias("lo"),
        F.coalesce(F.when(enough, hi), F.col("largest")).alias("hi"),
    )


def initial_ranges(values: DataFrame, params: LearnParams | None = None) -> DataFrame:
    """Range of every (model, field) before any refinement.

    Fields without a single number come out with ``n`` 0 and NULL bounds. A field holding nothing
    but booleans counts as 0/1; beside numbers or texts, booleans are texts.
    """
    p = params or LearnParams()
    # Everything below reads the counted values several times; the documents are read once.
    parts = _initial(settle(_counted(values, p)), p)
    body = F.struct("n", "smallest", "largest", "lo", "hi")
    kind = F.col("kind")
    merged = parts.groupBy(*GROUP).agg(
        F.max(F.when(kind == "number", body)).alias("_number"),
        F.max(F.when(kind == "bool", body)).alias("_bool"),
        F.bool_or(kind.isin("text", "forced")).alias("_text"),
    )
    only_bool = F.col("_number").isNull() & F.col("_bool").isNotNull() & ~F.col("_text")
    chosen = F.coalesce("_number", F.when(only_bool, F.col("_bool")))
    return merged.select(*GROUP, chosen.alias("_r"), only_bool.alias("is_bool")).select(
        *GROUP,
        F.coalesce("_r.n", F.lit(0)).cast("bigint").alias("n"),
        *[F.col(f"_r.{c}").alias(c) for c in ("smallest", "largest", "lo", "hi")],
        "is_bool",
    )


def refine(ranges: DataFrame, params: LearnParams | None = None) -> DataFrame:
    """Run the refinement stages, in the requested order, on (n, smallest, largest, lo, hi) rows.

    One projection per step, so the optimizer never multiplies the nested expressions.
    """
    p = params or LearnParams()
    lo, hi = F.col("lo"), F.col("hi")
    smallest, largest = F.col("smallest"), F.col("largest")
    others = [c for c in ranges.columns if c not in ("lo", "hi")]

    def put(df: DataFrame, pair: iv.Pair) -> DataFrame:
        return df.select(*others, pair[0].alias("lo"), pair[1].alias("hi"))

    for stage in check_stages(p.stages):
        if stage == "sign" and p.sign_clamp:
            ranges = put(ranges, iv.pin_to_sign(lo, hi, smallest, largest))
        elif stage == "expand":
            ranges = put(ranges, iv.widen(lo, hi, p.expand_pct))
            if p.post_expand_sign_clamp:
                ranges = put(ranges, iv.keep_sign(lo, hi, smallest, largest))
            if p.clamp_to_observed:
                ranges = put(ranges, iv.within_observed(lo, hi, smallest, largest))
        elif stage == "region_adjust" and p.region_adjust:
            ranges = put(ranges, iv.scale_about_centre(lo, hi, p.region_multiplier))
        elif stage == "field":
            pair = iv.limit_by_rules(
                lo,
                hi,
                F.col("model"),
                F.col("field"),
                p.bound_rules,
                fold_case=p.fold_case,
                fold_model_case=p.fold_model_case,
                apply_all=p.apply_all_rules,
            )
            # Without a number there is no interval to limit.
            known = F.col("n") > 0
            ranges = put(ranges, (F.when(known, pair[0]), F.when(known, pair[1])))
    return put(ranges, iv.rounded(lo, hi, p.round_decimals))


def learn_ranges(values: DataFrame, params: LearnParams | None = None) -> DataFrame:
    """model, variant, field, lo, hi, is_non_numeric, is_bool for every (model, field).

    ``values`` may be counted ones (``extract.count_cells``).
    """
    ranges = refine(initial_ranges(values, params), params)
    return ranges.select(
        "model",
        F.lit("base").alias("variant"),
        "field",
        "lo",
        "hi",
        (F.col("n") == 0).alias("is_non_numeric"),
        "is_bool",
    )
