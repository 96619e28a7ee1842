"""Exact order statistics per group, without ever putting a whole group into one task.

Values are first counted (equal values collapse before the shuffle). Ranks then come from running
totals over *chunks*: Spark cuts the rows into sorted ranges of about ``chunk_rows`` rows, the ranges
are written once, chunk totals are summed over that short list, and only a chunk at a time is sorted.
Tables that fit one chunk skip all that. Quantiles of larger tables are selected by counting digits, with no sort.

Inputs are read more than once: hand in settled tables (``fieldguard.session.settle``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldguard.session import settle, small_side

# Expected rows per chunk.
CHUNK_ROWS = 1 << 20
# Up to this many rows per group, Spark itself keeps only each task's best rows for a window.
LIMIT_PUSHED = 1000


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    """Join condition on key columns that also matches NULL with NULL."""
    return reduce(
        lambda x, y: x & y, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in names]
    )


def with_running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    weight: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``_before`` (weight of the rows sorted before this one in its group) and ``_total``.

    ``order`` must tell the rows of a group apart; NULL keys are a group like any other. Without
    ``weight`` every row counts 1, so ``_before + 1`` is the row number.

    Tables of more than ``chunk_rows`` rows are cut into sorted ranges of about that many rows and
    written once with the number of their range; both routes give the same rows.
    """
    keys, order = list(keys), list(order)
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    group = Window.partitionBy(*keys)
    sorted_order = [F.col(c).asc_nulls_last() for c in order]
    rows = df.count()
    if rows <= chunk_rows:
        running = group.orderBy(*sorted_order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        return df.withColumns(
            {"_before": F.sum(w).over(running) - w, "_total": F.sum(w).over(group)}
        )
    ranges = -(-rows // chunk_rows)
    ranged = df.repartitionByRange(ranges, *[F.col(c).asc_nulls_last() for c in keys], *sorted_order)
    cut = settle(ranged.withColumn("_chunk", F.spark_partition_id()))
    sums = cut.groupBy(*keys, "_chunk").agg(F.sum(w).alias("_sum"))
    earlier = group.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *keys,
        "_chunk",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(group).alias("_total"),
    )
    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(*sorted_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = cut.withColumn("_inside", F.sum(w).over(inside) - w)
    joined = placed.alias("r").join(offsets.alias("o"), _same("r", "o", [*keys, "_chunk"]))
    return joined.select(
        *[f"r.{c}" for c in df.columns],
        (F.col("o._offset") + F.col("r._inside")).alias("_before"),
        F.col("o._total").alias("_total"),
    )


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rank",
    *,
    chunk_rows: int = CHUNK_ROWS,
    total: str | None = None,
    settled: bool = False,
) -> DataFrame:
    """1-based position of every row in its group; same result as ``row_number``.

    ``df`` is settled first, unless it is a settled table already. ``total`` names a further column for the size of the group.
    """
    df = df if settled else settle(df)
    ranked = with_running_total(df, keys, order, chunk_rows=chunk_rows)
    ranked = ranked.withColumn(name, (F.col("_before") + 1).cast("bigint")).drop("_before")
    return ranked.withColumnRenamed("_total", total) if total else ranked.drop("_total")


def first_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    k: int,
    name: str = "rank",
    *,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The first ``k`` rows of every group with their position ``name``.

    For small ``k`` Spark keeps only each task's best ``k`` rows before the shuffle, so a hot
    group is no burden; for larger ``k`` the positions are counted in chunks.
    """
    if k > LIMIT_PUSHED:
        ranked = row_numbers(df, keys, order, name, chunk_rows=chunk_rows)
    else:
        place = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
        ranked = df.withColumn(name, F.row_number().over(place).cast("bigint"))
    return ranked.filter(F.col(name) <= k)


def count_values(values: DataFrame, keys: Sequence[str], x: str) -> DataFrame:
    """(keys, x, _count): how often each value occurs. Rows with a ``_count`` of their own stand for so many."""
    number = F.sum("_count") if "_count" in values.columns else F.count(F.lit(1))
    return values.groupBy(*keys, x).agg(number.alias("_count"))


def _rank_parts(total: Column, q: float) -> tuple[Column, Column]:
    """Index below a linear-interpolated quantile, and the fraction beyond it."""
    place = (total - 1) * F.lit(float(q))
    low = F.floor(place)
    return low, place - low


# Buckets of a selection round: steps of an octave in the first, equal parts of what is left in later ones.
OCTAVE_STEPS, PARTS = 8, 4096
_BEYOND = OCTAVE_STEPS * 1200


def _high_digits(x: Column) -> Column:
    """Sign and exponent of a double as a whole number that rises with it; infinities stand apart."""
    step = F.floor(F.least(F.log2(F.abs(x)) * OCTAVE_STEPS, F.lit(float(_BEYOND - 1)))).cast("bigint")
    size = step + F.lit(_BEYOND).cast("bigint")
    return F.when(x == 0, F.lit(0).cast("bigint")).when(x > 0, size).otherwise(-size)


def _part_of(x: Column, lo: Column, hi: Column) -> Column:
    """Which of ``PARTS`` equal parts of [lo, hi] holds x; rises with x."""
    return F.least(F.floor((x - lo) / (hi - lo) * PARTS), F.lit(PARTS - 1)).cast("bigint")


def select_ranks(
    counts: DataFrame, keys: Sequence[str], x: str, wanted: DataFrame, *, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """The value at each wanted place of the sorted values of its group, without sorting them.

    ``counts``: settled (keys, x, _count) rows, not NULL or NaN; an x may come more than once. ``wanted``: keys, ``_t``
    (which of the group's places), ``_rank`` (from 0), ``_lo`` and ``_hi`` (bounds of the group's values). Gives keys, ``_t``, ``_value``.

    Values are counted by their high digits (sign and exponent, then equal parts of what is left), combined
    before the shuffle; only the bucket that holds a wanted place is looked into again. Each round divides
    the values' width by thousands, so five rounds end any case; as soon as no more than ``chunk_rows`` rows
    are left in all of them together, those few are ranked.
    """
    keys, first = list(keys), True
    found, open_, left = None, wanted.select(*keys, "_t", "_rank", "_lo", "_hi"), None
    while True:
        solved = open_.where("_lo = _hi").select(*keys, "_t", F.col("_lo").alias("_value"))
        found = solved if found is None else found.unionByName(solved)
        if left is not None and left <= chunk_rows:
            break
        target = small_side(open_.where("_lo < _hi"))
        near = counts.alias("c").join(target.alias("w"), _same("c", "w", keys))
        value = F.col(f"c.{x}")
        near = near.where(value.between(F.col("w._lo"), F.col("w._hi")))
        bucket = _high_digits(value) if first else _part_of(value, F.col("w._lo"), F.col("w._hi"))
        near = near.select(*[F.col(f"w.{k}") for k in keys], "w._t", "w._rank", bucket.alias("_bucket"), value.alias("_x"), "c._count")
        held = near.groupBy(*keys, "_t", "_rank", "_bucket").agg(
            F.sum("_count").alias("_weight"), F.count("*").alias("_rows"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")
        )
        upto = Window.partitionBy(*keys, "_t").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        held = held.withColumn("_before", F.sum("_weight").over(upto) - F.col("_weight"))
        held = held.where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_weight")))
        open_ = settle(held.select(*keys, "_t", (F.col("_rank") - F.col("_before")).alias("_rank"), "_lo", "_hi", "_rows"))
        left = open_.where("_lo < _hi").agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
        first = False
    if left == 0:
        return found
    target = small_side(open_.where("_lo < _hi"))
    near = counts.alias("c").join(target.alias("w"), _same("c", "w", keys))
    near = near.where(F.col(f"c.{x}").between(F.col("w._lo"), F.col("w._hi")))
    near = near.select(*[F.col(f"w.{k}") for k in keys], "w._t", "w._rank", F.col(f"c.{x}").alias("_x"), "c._count")
    upto = Window.partitionBy(*keys, "_t").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("_before", F.sum("_count").over(upto) - F.col("_count"))
    near = near.where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_count")))
    return found.unionByName(near.select(*keys, "_t", F.col("_x").alias("_value")))


def quantiles(
    counts: DataFrame,
    keys: Sequence[str],
    x: str,
    probabilities: Sequence[float],
    *,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Exact quantiles (linear interpolation) of counted, non-NULL values.

    Gives keys, ``n``, ``smallest``, ``largest`` and ``q0``, ``q1``, ... per probability. Up to
    ``chunk_rows`` rows are ranked; more are never sorted, see ``select_ranks``. Equal values may come as several rows.
    """
    keys = list(keys)
    bounds = [F.min(x).alias("smallest"), F.max(x).alias("largest")]
    if counts.count() > chunk_rows:
        groups = settle(counts.groupBy(*keys).agg(F.sum("_count").alias("n"), *bounds))
        ranks = []
        for q in probabilities:
            low, _ = _rank_parts(F.col("n"), q)
            ranks += [low, F.least(low + 1, F.col("n") - 1)]
        numbered = F.array(*[F.struct(F.lit(i).alias("_t"), r.cast("bigint").alias("_rank")) for i, r in enumerate(ranks)])
        # A group of gaps or texts has rows, but no values to rank.
        wanted = groups.where("smallest IS NOT NULL").select(
            *keys, F.inline(numbered), F.col("smallest").alias("_lo"), F.col("largest").alias("_hi")
        )
        picked = select_ranks(counts.where(F.col(x).isNotNull()), keys, x, settle(wanted), chunk_rows=chunk_rows)
        values = picked.groupBy(*keys).agg(
            *[
                F.max(F.when(F.col("_t") == 2 * i + j, F.col("_value"))).alias(f"_{side}{i}")
                for i in range(len(probabilities))
                for j, side in enumerate(("low", "high"))
            ]
        )
        sides = [f"_{side}{i}" for i in range(len(probabilities)) for side in ("low", "high")]
        found = groups.alias("g").join(values.alias("v"), _same("g", "v", keys), "left")
        found = found.select("g.*", *[f"v.{c}" for c in sides])
    else:
        ranked = with_running_total(counts, keys, [x], weight="_count", chunk_rows=chunk_rows)
        start, stop = F.col("_before"), F.col("_before") + F.col("_count")
        aggs = [F.max("_total").alias("n"), *bounds]
        for i, q in enumerate(probabilities):
            low, _ = _rank_parts(F.col("_total"), q)
            aggs.append(F.max(F.when((start <= low) & (low < stop), F.col(x))).alias(f"_low{i}"))
            high = F.least(low + 1, F.col("_total") - 1)
            aggs.append(F.max(F.when((start <= high) & (high < stop), F.col(x))).alias(f"_high{i}"))
        found = ranked.groupBy(*keys).agg(*aggs)
    out = []
    for i, q in enumerate(probabilities):
        _, part = _rank_parts(F.col("n"), q)
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        # Touch the upper neighbour only when needed: inf - inf must not spoil an exact hit.
        out.append(F.when(part == 0, low).otherwise(low + (high - low) * part).alias(f"q{i}"))
    return found.select(*keys, "n", "smallest", "largest", *out)


def shortest_cover(
    counts: DataFrame,
    keys: Sequence[str],
    x: str,
    share: float,
    *,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Narrowest interval holding ceil(share * n) of the sorted values; the first one on ties.

    Gives keys, ``n``, ``smallest``, ``largest``, ``lo``, ``hi``. For each distinct value the
    interval starting there must reach the value ``k - 1`` places further on. That value is found
    without pairing rows: starts and their target places are laid out on one line of ranks, cut
    into blocks of equal length, and each block is swept once.
    """
    share = min(max(float(share), 0.0), 1.0)
    ranked = with_running_total(counts, keys, [x], weight="_count", chunk_rows=chunk_rows)
    block_len = F.lit(chunk_rows).cast("bigint")
    needed = F.greatest(
        F.lit(1), F.least(F.ceil(F.lit(share) * F.col("_total")), F.col("_total"))
    ).cast("bigint")
    middle = F.floor(F.col("_total") / 2)
    rows = ranked.select(
        *keys,
        F.col(x).alias("_x"),
        "_before",
        "_count",
        "_total",
        needed.alias("_k"),
        ((F.col("_before") <= middle) & (middle < F.col("_before") + F.col("_count"))).alias("_mid"),
    )
    def block_of(place: Column) -> Column:
        return F.floor(place / block_len).cast("bigint")

    last = F.col("_before") + F.col("_count") - 1

    def mark(block: Column) -> Column:
        return F.struct(
            block.alias("_block"),
            F.greatest(F.col("_before"), block * block_len).alias("_place"),
            F.lit(0).alias("_side"),
        )

    # A value reaching into further blocks is marked at the start of each of them.
    marks = F.when(
        block_of(F.col("_before")) == block_of(last), F.array(mark(block_of(F.col("_before"))))
    ).otherwise(F.transform(F.sequence(block_of(F.col("_before")), block_of(last)), mark))
    target = F.col("_before") + F.col("_k") - 1
    probe = F.struct(
        block_of(target).alias("_block"), target.alias("_place"), F.lit(1).alias("_side")
    )
    probes = F.when(target < F.col("_total"), F.array(probe)).otherwise(
        F.array().cast("array<struct<_block:bigint,_place:bigint,_side:int>>")
    )
    line = rows.select(
        *keys, "_x", "_before", "_total", "_k", "_mid", F.inline(F.concat(marks, probes))
    )
    sweep = (
        Window.partitionBy(*keys, "_block")
        .orderBy("_place", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    is_mark = F.col("_side") == 0
    reached = F.last(F.when(is_mark, F.col("_x")), ignorenulls=True).over(sweep)
    swept = line.withColumn("_hi", reached)
    width = F.col("_hi") - F.col("_x")
    comparable = F.when(
        F.isnan(width) | (width == float("inf")), F.lit(float("inf"))
    ).otherwise(width)
    best = F.min_by(
        F.struct(F.col("_x").alias("lo"), F.col("_hi").alias("hi")),
        F.when(~is_mark, F.struct(comparable, F.col("_before"))),
    )
    found = swept.groupBy(*keys).agg(
        F.max("_total").alias("n"),
        F.min("_x").alias("smallest"),
        F.max("_x").alias("largest"),
        F.max("_k").alias("_k"),
        F.max(F.when(F.col("_mid"), F.col("_x"))).alias("_centre"),
        best.alias("_best"),
    )
    if share <= 0.0:
        lo = hi = F.col("smallest")
    else:
        one = F.col("_k") == 1
        lo = F.when(one, F.col("_centre")).otherwise(F.col("_best.lo"))
        hi = F.when(one, F.col("_centre")).otherwise(F.col("_best.hi"))
    return found.select(*keys, "n", "smallest", "largest", lo.alias("lo"), hi.alias("hi"))
