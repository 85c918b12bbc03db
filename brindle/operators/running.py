"""Running aggregates that no single key can overload.

``Window.partitionBy(key)`` sends all rows of a key to one task. That is right for
almost all keys. The few that are too large are taken apart:

1. their rows are first aggregated per instant, so copies collapse before the shuffle;
2. the time axis is cut into slots, each a window group of its own, with one extra
   row that carries in what lies before the slot. The carried values come from the
   same step on the slot totals with wider slots, so a group holds at most
   (wider width / narrower width) rows however many rows the key has;
3. the results are joined back to the rows by key and instant.

Sum and max can be regrouped this way without changing the result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.sources.scratch import new_place

# Rows from which a key counts as too large for one task.
MIN_LARGE = 1_000_000

# new column -> (associative function, input column)
Aggregates = Mapping[str, tuple[Callable[[Column], Column], str]]


def before(
    rows: DataFrame,
    key: str,
    at: str,
    aggregates: Aggregates,
    widths: Sequence[int],
    large: DataFrame | None = None,
) -> DataFrame:
    """Add, per key, aggregates over the rows with a strictly smaller ``at``.

    ``widths`` are slot widths from wide to narrow for the keys in ``large``, which
    comes from ``large_keys``. Null where no row comes before. Rows without ``at``
    must have null inputs; they then count for no other row.
    """
    if large is None:
        return _within(rows, [key], at, aggregates)

    flagged = _flag_large(rows, key, large)
    usual = _within(flagged.where("_large is null"), [key], at, aggregates)

    taken_apart = flagged.where("_large")
    inputs = {source: function for function, source in aggregates.values()}
    instants = taken_apart.groupBy(F.col(key).alias("_key"), F.col(at).alias("_instant")).agg(
        *[function(F.col(source)).alias(source) for source, function in inputs.items()]
    )
    placed = _in_slots(instants, "_key", "_instant", aggregates, widths).drop(*inputs)
    # adaptive execution splits the partition of an instant that holds very many rows
    same_instant = F.col(key).eqNullSafe(F.col("_key")) & F.col(at).eqNullSafe(
        F.col("_instant")
    )
    rejoined = taken_apart.join(placed, same_instant, "left").drop("_key", "_instant")
    return usual.unionByName(rejoined).drop("_large")


def large_keys(rows: DataFrame, key: str, min_rows: int = MIN_LARGE) -> DataFrame | None:
    """The keys that hold more than ``min_rows`` rows, or None if there is none.

    Finding them reads the key column once. The list, at most one
    ``min_rows``-th as long as ``rows``, is written to the shared folder: it is
    not worked out again for each use, and Spark knows its true size.
    """
    spark = rows.sparkSession
    large = (
        rows.groupBy(key)
        .agg(F.count("*").alias("_size"))
        .where(F.col("_size") > min_rows)
        .select(key)
    )
    place = new_place(spark, "large-keys")
    large.write.parquet(place)
    kept = spark.read.schema(large.schema).parquet(place)
    return None if kept.isEmpty() else kept


def _flag_large(rows: DataFrame, key: str, large: DataFrame) -> DataFrame:
    """Add ``_large``: true for rows of the large keys, null for the others.

    No broadcast hint: the list is a written table, so Spark broadcasts it if its
    file size is below the threshold and otherwise joins by sorted key, where
    adaptive execution splits the large keys' partitions.
    """
    listed = large.select(F.col(key).alias("_listed"), F.lit(True).alias("_large"))
    same_key = F.col(key).eqNullSafe(F.col("_listed"))
    return rows.join(listed, same_key, "left").drop("_listed")


def _in_slots(
    rows: DataFrame, key: str, at: str, aggregates: Aggregates, widths: Sequence[int]
) -> DataFrame:
    """The same result as ``_within`` by key, through slots of the given widths."""
    if not widths:
        return _within(rows, [key], at, aggregates)

    *wider, width = widths
    inputs = {source: function for function, source in aggregates.values()}
    slotted = rows.withColumn("_slot", F.col(at) - F.pmod(F.col(at), F.lit(width)))
    totals = slotted.groupBy(key, F.col("_slot").alias("_start")).agg(
        *[function(F.col(source)).alias(source) for source, function in inputs.items()]
    )
    carried = _in_slots(totals, key, "_start", aggregates, wider).select(
        key,
        F.col("_start").alias("_slot"),
        (F.col("_start") - 1).alias(at),
        *[F.col(name).alias(source) for name, (_, source) in aggregates.items()],
        F.lit(True).alias("_carried"),
    )
    together = slotted.withColumn("_carried", F.lit(False)).unionByName(
        carried, allowMissingColumns=True
    )
    return (
        _within(together, [key, "_slot"], at, aggregates)
        .where(~F.col("_carried"))
        .drop("_slot", "_carried")
    )


def _within(
    rows: DataFrame, groups: Sequence[str], at: str, aggregates: Aggregates
) -> DataFrame:
    earlier = (
        Window.partitionBy(*groups)
        .orderBy(at)
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    return rows.withColumns(
        {
            name: function(F.col(source)).over(earlier)
            for name, (function, source) in aggregates.items()
        }
    )
