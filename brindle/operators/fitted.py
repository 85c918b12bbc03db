"""Columns computed from statistics of a chosen part of the rows.

``fit`` is a condition, usually a period: statistics come from the rows it holds
for and are applied to all rows. A fit brings back a few numbers whose count does
not depend on the data, and applying them is a projection without shuffle; means
per category stay a table and are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions import DIGITS, scaled
from brindle.sources.scratch import new_place

# Slots into which each pass of ``cut_points`` divides a stretch of the axis.
SLOTS = 10_000


def standardise(
    rows: DataFrame,
    cols: Sequence[str],
    fit: Column,
    keep: Sequence[str],
    digits: int = DIGITS,
) -> DataFrame:
    """z-score and min-max scaling of ``cols``; a missing value counts as the mean.

    Null where the fitted rows are all equal or all missing.
    """
    statistics = []
    for c in cols:
        x = scaled(F.col(c), digits)
        square = x.cast("decimal(18,0)") * x.cast("decimal(18,0)")
        statistics += [
            F.count(x).alias(f"n_{c}"),
            F.sum(x.cast("decimal(18,0)")).alias(f"sum_{c}"),
            F.sum(square).alias(f"squares_{c}"),
            F.min(x).alias(f"low_{c}"),
            F.max(x).alias(f"high_{c}"),
        ]
    fitted = rows.where(fit).agg(*statistics).first()

    out = []
    for c in cols:
        n, total, squares, low, high = (
            int(fitted[f"{s}_{c}"] or 0) for s in ("n", "sum", "squares", "low", "high")
        )
        z = unit = F.lit(None).cast("double")
        if n and high > low:
            mean = total / n
            # whole numbers up to here: nothing cancels when the mean is far from zero
            deviation = (float(n * squares - total * total) / float(n * (n - 1))) ** 0.5
            x = F.coalesce(scaled(F.col(c), digits).cast("double"), F.lit(mean))
            z = (x - F.lit(mean)) / F.lit(deviation)
            unit = (x - F.lit(float(low))) / F.lit(float(high - low))
        out += [z.alias(f"{c}_z"), unit.alias(f"{c}_unit")]
    return rows.select(*keep, *out)


def cut_points(rows: DataFrame, value: Column, n: int) -> list[int] | None:
    """The n-1 interpolated quantiles of bigint ``value``, times n to stay whole.

    None without values. Exact, as the ``percentile`` aggregate is, but that one
    holds all distinct values in one task. This narrows down: each pass counts the
    rows per slot in the stretches that enclose a quantile and keeps the enclosing
    slots, until a slot is a single value. With 10^4 slots a range of 10^12 takes
    three passes, and only slot counts are shuffled. The values are worked out once and
    written as a table of one column, which the passes read.
    """
    spark, place = rows.sparkSession, new_place(rows.sparkSession, "quantile-values")
    rows.select(value.cast("bigint").alias("x")).where(F.col("x").isNotNull()).write.parquet(place)
    axis = spark.read.schema("x bigint").parquet(place)
    total, low, high = axis.agg(F.count("*"), F.min("x"), F.max("x")).first()
    if not total:
        return None
    positions = [divmod((total - 1) * i, n) for i in range(1, n)]
    ranks = sorted({rank + extra for rank, rest in positions for extra in (0, bool(rest))})

    width = 1
    while width * SLOTS <= high - low:
        width *= SLOTS
    # rank -> start of the stretch that holds it, rows before that stretch
    enclosing = {rank: (0, 0) for rank in ranks}
    stretch = F.lit(0)
    while ranks:
        enclosing = _narrow(axis, stretch, _slot(width), enclosing)
        if width == 1:
            break
        stretch, width = _slot(width), width // SLOTS

    def at(rank: int) -> int:
        return enclosing[rank][0]

    return [
        at(rank) * n + (rest * (at(rank + 1) - at(rank)) if rest else 0)
        for rank, rest in positions
    ]


def _slot(width: int) -> Column:
    return F.col("x") - F.pmod(F.col("x"), F.lit(width))


def _narrow(
    axis: DataFrame, stretch: Column, slot: Column, enclosing: dict[int, tuple[int, int]]
) -> dict[int, tuple[int, int]]:
    """For each rank, the start of the slot that holds it and the rows before that."""
    stretches = sorted({begin for begin, _ in enclosing.values()})
    counts = (
        axis.select("x", stretch.alias("stretch"))
        .where(F.col("stretch").isin(stretches))
        .groupBy("stretch", slot.alias("slot"))
        .agg(F.count("*").alias("here"))
    )
    up_to_here = (
        Window.partitionBy("stretch")
        .orderBy("slot")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    holds_a_rank = " or ".join(
        f"(stretch = {begin} and upto > {rank - before} and upto - here <= {rank - before})"
        for rank, (begin, before) in enclosing.items()
    )
    holders = (
        counts.withColumn("upto", F.sum("here").over(up_to_here))
        .where(holds_a_rank)
        .collect()  # at most one row per rank
    )
    found = {}
    for rank, (begin, before) in enclosing.items():
        for row in holders:
            below = before + row.upto - row.here
            if row.stretch == begin and below <= rank < below + row.here:
                found[rank] = (row.slot, below)
    return found


def bin_of(value: Column, cuts: Sequence[int] | None, n: int) -> Column:
    """Number of cut points below ``value``, 0 to n-1; null for null."""
    if cuts is None:
        return F.lit(None).cast("bigint")
    floors = F.lit([cut // n for cut in cuts])  # value * n > cut if value > cut // n
    below = F.size(F.filter(floors, lambda cut: cut < value))
    return F.when(value.isNotNull(), below.cast("bigint"))


def quantile_bins(
    rows: DataFrame,
    col: str,
    fit: Column,
    keep: Sequence[str],
    n: int = 10,
    digits: int = DIGITS,
) -> DataFrame:
    """Bin of each row between quantiles of the fitted rows."""
    value = scaled(F.col(col), digits)
    cuts = cut_points(rows.where(fit), value, n)
    return rows.select(*keep, col, bin_of(value, cuts, n).alias("bin"))


def smoothed_means(
    rows: DataFrame,
    category: str,
    outcome: Column,
    fit: Column,
    keep: Sequence[str],
    strength: float = 10.0,
) -> DataFrame:
    """Mean 0/1 outcome of the row's category, drawn to the overall mean.

    A category counts as if it had ``strength`` more rows with the overall mean;
    one without fitted rows gets that mean. A missing outcome counts for nothing. A
    fitted row's own outcome is part of the mean it gets, so a model fitted on the same
    rows sees it; fit the means on an earlier period than the model.
    """
    per_category = (
        rows.where(fit)
        .groupBy(F.col(category).alias("_category"))
        .agg(F.count(outcome).alias("_n"), F.count_if(outcome).alias("_ones"))
    )
    # As a written table it is fitted once and Spark knows its true size: it is
    # broadcast if small enough, else joined by sorted key, where adaptive
    # execution splits a hot category's partition.
    place = new_place(rows.sparkSession, "category-means")
    per_category.write.parquet(place)
    stored = rows.sparkSession.read.schema(per_category.schema).parquet(place)
    n, ones = stored.agg(F.sum("_n"), F.sum("_ones")).first()
    overall = F.lit(ones / n if n else None).cast("double")
    means = stored.select(
        "_category",
        (
            (F.col("_ones") + F.lit(strength) * overall) / (F.col("_n") + F.lit(strength))
        ).alias("_mean"),
    )
    same = F.col(category).eqNullSafe(F.col("_category"))
    return rows.join(means, same, "left").select(
        *keep, category, F.coalesce("_mean", overall).alias("encoded")
    )
