"""Features of an event from the events before it, and sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions import (
    DIGITS,
    exact,
    from_micros,
    interval_micros,
    micros,
)
from brindle.operators.running import MIN_LARGE, before, large_keys

# Slot widths for keys too large for one task: a group holds the hours of a key,
# the seconds of an hour, or the instants of a second.
TIME_WIDTHS = tuple(interval_micros(w) for w in ("1 hour", "1 second"))


def trailing_features(
    events: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    value: str = "value",
    span: str = "7 days",
    keep: Sequence[str] = ("event_id",),
    min_large: int = MIN_LARGE,
    digits: int = DIGITS,
) -> DataFrame:
    """Per event, count and value sum over the key's preceding ``span``.

    An event enters the sums of later events once its time has passed and leaves
    them ``span`` later, so two running sums give the answer in one pass. A
    sliding frame would add up the whole frame again for each event.
    """
    span_us = interval_micros(span)
    timed = events.select(
        *keep,
        *[c for c in (key, ts) if c not in keep],
        exact(F.col(value), digits).alias("_value"),
        micros(F.col(ts)).alias("_at"),
    )
    timed_row = F.col("_move.at").isNotNull()
    moves = timed.withColumn(
        "_move",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("sign"), F.col("_at").alias("at")),
                F.struct(F.lit(-1).alias("sign"), (F.col("_at") + span_us).alias("at")),
            )
        ),
    ).select(
        key,
        *[
            F.when(F.col("_move.sign") == 1, F.col(c)).alias(c)
            for c in {**dict.fromkeys(keep), ts: None}
            if c != key
        ],
        F.col("_move.at").alias("_at"),
        (F.col("_move.sign") == 1).alias("_enters"),
        F.when(timed_row, F.col("_move.sign").cast("bigint")).alias("_count"),
        F.when(
            timed_row,
            F.when(F.col("_move.sign") == 1, F.col("_value")).otherwise(-F.col("_value")),
        ).alias("_sum"),
    )
    result = before(
        moves,
        key,
        "_at",
        {"_n": (F.sum, "_count"), "_s": (F.sum, "_sum")},
        TIME_WIDTHS,
        large_keys(events, key, min_large),
    )
    return result.where("_enters").select(
        *keep,
        *[c for c in (key, ts) if c not in keep],
        F.coalesce("_n", F.lit(0)).alias("n_before"),
        F.coalesce(F.col("_s").cast("double"), F.lit(0.0)).alias("sum_before"),
    )


def as_of_feature(
    rows: DataFrame,
    target: Column,
    feature: Column,
    key: str = "user_id",
    ts: str = "ts",
    order: str = "event_id",
    value: str = "value",
    min_large: int = MIN_LARGE,
) -> DataFrame:
    """Per target row, the key's latest feature row that is strictly earlier.

    ``target`` and ``feature`` are conditions on ``rows``; to match two tables,
    union them first. Of feature rows at one instant the largest ``order`` wins.
    """
    wanted = rows.where(target | feature)
    timed = wanted.select(
        order,
        key,
        ts,
        F.col(value).alias("_value"),
        micros(F.col(ts)).alias("_at"),
        target.alias("_target"),
        feature.alias("_feature"),
    ).withColumn(
        "_latest",
        F.when(
            F.col("_feature") & F.col("_at").isNotNull(),
            F.struct(
                F.col("_at").alias("at"),
                F.col(order).alias("order"),
                F.col("_value").alias("value"),
            ),
        ),
    )
    found = before(
        timed,
        key,
        "_at",
        {"_match": (F.max, "_latest")},
        TIME_WIDTHS,
        large_keys(wanted, key, min_large),
    )
    return found.where("_target").select(
        order,
        key,
        ts,
        F.col("_match.order").alias(f"feature_{order}"),
        from_micros(F.col("_match.at")).alias("feature_ts"),
        F.col("_match.value").alias("feature_value"),
    )


def session_features(
    events: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    type_col: str = "event_type",
    gap: str = "12 hours",
) -> DataFrame:
    """Sessions of a key: a new one starts after more than ``gap`` of silence.

    Two events in one cell of width ``gap`` are never further apart than that,
    so each cell belongs to one session and is aggregated before anything is
    ordered. What is ordered per key is at most (time covered / gap) cells for
    each type, not the key's events.
    """
    gap_us = interval_micros(gap)
    cells = (
        events.select(key, F.col(type_col).alias("_type"), micros(F.col(ts)).alias("_at"))
        .groupBy(
            key,
            (F.col("_at") - F.pmod(F.col("_at"), F.lit(gap_us))).alias("_cell"),
            "_type",
        )
        .agg(
            F.min("_at").alias("_first"),
            F.max("_at").alias("_last"),
            F.count("*").alias("_n"),
        )
    )
    in_order = Window.partitionBy(key).orderBy("_first", "_last", "_type")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, -1)
    up_to_now = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous = F.max("_last").over(so_far)
    starts = cells.withColumn(
        "_opens",
        F.when(previous.isNull() | (F.col("_first") - previous > gap_us), F.col("_first")),
    ).withColumn("_start", F.max("_opens").over(up_to_now))
    return (
        starts.groupBy(key, "_start", "_type")
        .agg(F.max("_last").alias("_last"), F.sum("_n").alias("_n"))
        .groupBy(key, "_start")
        .agg(
            F.max("_last").alias("_last"),
            F.sum("_n").alias("n_events"),
            F.count("_type").alias("n_types"),
        )
        .select(
            key,
            from_micros(F.col("_start")).alias("session_start"),
            from_micros(F.col("_last")).alias("session_last"),
            "n_events",
            "n_types",
        )
    )
