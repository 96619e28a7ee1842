"""Interval arithmetic on (lo, hi) column pairs. NULL-free inputs give NULL-free results."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

Pair = tuple[Column, Column]


def finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != float("inf"))


def ordered(lo: Column, hi: Column) -> Pair:
    """An upper bound below the lower bound collapses onto it."""
    return lo, F.when(lo > hi, lo).otherwise(hi)


def pin_to_sign(lo: Column, hi: Column, smallest: Column, largest: Column) -> Pair:
    """One-signed data: the bound next to zero becomes the observed extreme."""
    return ordered(
        F.when(smallest >= 0, smallest).otherwise(lo),
        F.when(largest <= 0, largest).otherwise(hi),
    )


def widen(lo: Column, hi: Column, share: float) -> Pair:
    """Grow both ends by ``share`` of the width (negative shrinks; crossing ends meet midway)."""
    if not math.isfinite(share) or share == 0:
        return lo, hi
    width = hi - lo
    scale = F.greatest(F.abs(lo), F.abs(hi), F.lit(1.0))
    step = F.when(finite(width) & (width != 0), width).otherwise(scale) * F.lit(float(share))
    new_lo, new_hi = lo - step, hi + step
    middle = (new_lo + new_hi) / 2
    crossed = new_lo > new_hi
    return F.when(crossed, middle).otherwise(new_lo), F.when(crossed, middle).otherwise(new_hi)


def keep_sign(lo: Column, hi: Column, smallest: Column, largest: Column) -> Pair:
    """One-signed data: the interval may not reach across zero."""
    return ordered(
        F.when(smallest >= 0, F.greatest(lo, F.lit(0.0))).otherwise(lo),
        F.when(largest <= 0, F.least(hi, F.lit(0.0))).otherwise(hi),
    )


def within_observed(lo: Column, hi: Column, smallest: Column, largest: Column) -> Pair:
    return ordered(F.greatest(lo, smallest), F.least(hi, largest))


def scale_about_centre(lo: Column, hi: Column, factor: Column | float) -> Pair:
    """Multiply the width; degenerate widths and unusable factors leave the interval alone."""
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    width = hi - lo
    usable = finite(factor) & (factor > 0) & (factor != 1) & finite(width) & (width != 0)
    centre = (lo + hi) / 2
    half = width * factor / 2
    usable = F.coalesce(usable, F.lit(False))
    return F.when(usable, centre - half).otherwise(lo), F.when(usable, centre + half).otherwise(hi)


def rounded(lo: Column, hi: Column, decimals: int | None) -> Pair:
    if decimals is None:
        return lo, hi
    return F.round(lo, decimals), F.round(hi, decimals)


@dataclass(frozen=True)
class BoundRule:
    """Limits for the ends of an interval, for fields containing every given text."""

    contains: Sequence[str]
    models: Sequence[str] = field(default_factory=tuple)
    min_lo: float | None = None
    max_lo: float | None = None
    min_hi: float | None = None
    max_hi: float | None = None


def texts_occur(text: Column, contains: Sequence[str], fold_case: bool) -> Column:
    """True if every non-empty text occurs; an empty list never matches."""
    if not contains:
        return F.lit(False)
    hay = F.lower(text) if fold_case else text
    hit = F.lit(True)
    for part in contains:
        if part:
            hit = hit & hay.contains(part.lower() if fold_case else part)
    return hit


def model_listed(model: Column, models: Sequence[str], fold_case: bool) -> Column:
    names = [m.strip() for m in models if m and m.strip()]
    if not names:
        return F.lit(True)
    own = F.trim(model)
    if fold_case:
        return F.lower(own).isin(*[n.lower() for n in names])
    return own.isin(*names)


def limit_by_rules(
    lo: Column,
    hi: Column,
    model: Column,
    name: Column,
    rules: Sequence[BoundRule],
    *,
    fold_case: bool = True,
    fold_model_case: bool = True,
    apply_all: bool = True,
) -> Pair:
    """Fold the matching rules over (lo, hi), in order.

    Rules naming the model come first: if one of them matches, general rules are skipped. The
    matching rules are gathered in an array and folded with ``aggregate``, so the expression
    grows with the number of rules and not with its powers.
    """
    if not rules:
        return ordered(lo, hi)

    def bound(x: float | None) -> Column:
        ok = x is not None and math.isfinite(float(x))
        return F.lit(float(x) if ok else None).cast("double")

    entries = []
    for rule in rules:
        special = bool([m for m in rule.models if m and m.strip()])
        entries.append(
            F.struct(
                (
                    texts_occur(name, rule.contains, fold_case)
                    & model_listed(model, rule.models, fold_model_case)
                ).alias("hit"),
                F.lit(special).alias("special"),
                bound(rule.min_lo).alias("min_lo"),
                bound(rule.max_lo).alias("max_lo"),
                bound(rule.min_hi).alias("min_hi"),
                bound(rule.max_hi).alias("max_hi"),
            )
        )
    hits = F.filter(F.array(*entries), lambda r: r["hit"])
    special = F.filter(hits, lambda r: r["special"])
    chosen = F.when(F.size(special) > 0, special).otherwise(hits)
    if not apply_all:
        chosen = F.slice(chosen, 1, 1)
    # greatest / least pass over NULL limits.
    folded = F.aggregate(
        chosen,
        F.struct(lo.cast("double").alias("lo"), hi.cast("double").alias("hi")),
        lambda acc, r: F.struct(
            F.least(F.greatest(acc["lo"], r["min_lo"]), r["max_lo"]).alias("lo"),
            F.least(F.greatest(acc["hi"], r["min_hi"]), r["max_hi"]).alias("hi"),
        ),
    )
    return ordered(folded["lo"], folded["hi"])
