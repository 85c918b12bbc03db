"""Features that one grouped aggregation gives.

All aggregates here merge (count, sum, max), so Spark combines them before the
shuffle and a hot key reaches its reducer as one row per input partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions import DIGITS, exact, exact_sum, from_micros, interval_micros, micros


def order_features(customers: DataFrame, orders: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Per customer: order count, spend, mean and last date; all customers kept.

    Prices are summed exactly with ``digits`` digits after the point. An order without
    a price counts as an order and not in the mean.
    """
    per_customer = (
        orders.groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count("*").alias("n_orders"),
            exact_sum(exact(F.col("o_totalprice"), digits)).cast("double").alias("total"),
            F.count(F.nanvl("o_totalprice", F.lit(None).cast("double"))).alias("n_priced"),
            F.max("o_orderdate").alias("last_order"),
        )
    )
    return (
        customers.select("c_custkey")
        .join(per_customer, "c_custkey", "left")
        .select(
            "c_custkey",
            F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
            F.coalesce("total", F.lit(0.0)).alias("spend"),
            (F.col("total") / F.col("n_priced")).alias("mean_order"),
            "last_order",
        )
    )


def event_counts(
    events: DataFrame,
    key: str,
    types: Sequence[str],
    type_col: str = "event_type",
    value: str = "value",
    digits: int = DIGITS,
) -> DataFrame:
    """Per key, one count and one value sum for each of the given types, and for all
    others together (``n_other``, ``sum_other``; a null type is among them).

    Conditional sums instead of ``pivot``: one shuffle by ``key`` rather than one
    by key and type and a second by key.
    """
    sums = []
    listed = F.coalesce(F.col(type_col).isin(*types), F.lit(False))
    for name, is_type in [*((t, F.col(type_col) == t) for t in types), ("other", ~listed)]:
        sums.append(F.count_if(is_type).alias(f"n_{name}"))
        sums.append(
            F.coalesce(
                exact_sum(F.when(is_type, exact(F.col(value), digits))).cast("double"), F.lit(0.0)
            ).alias(f"sum_{name}")
        )
    return events.groupBy(key).agg(*sums)


def window_counts(
    events: DataFrame,
    ts: str,
    by: str,
    size: str,
    slide: str | None = None,
) -> DataFrame:
    """Rows per time window and ``by``; tumbling unless ``slide`` is given.

    Counted first per pane, the longest stretch that no window cuts, so that a
    row is not copied into each sliding window that holds it. Windows begin at
    multiples of their step since 1970. Rows without a time are counted, once, with
    null for the window.
    """
    length = interval_micros(size)
    step = interval_micros(slide or size)
    width = math.gcd(length, step)
    at = micros(F.col(ts))
    panes = events.groupBy((at - F.pmod(at, F.lit(width))).alias("pane"), by).agg(F.count("*").alias("n"))
    if step == length == width:
        windows = panes.select(F.col("pane").alias("start"), by, F.col("n").alias("n_events"))
        return _with_bounds(windows, by, length)
    into = F.pmod(F.col("pane"), F.lit(step))
    latest = F.col("pane") - into
    back = F.floor((F.lit(length - 1) - into) / F.lit(step)) * F.lit(step)
    starts = F.when(into < length, F.sequence(latest - back, latest, F.lit(step)))
    # a pane in a gap between windows is in none; one without a time stays
    held = panes.where(into.isNull() | (into < length)).select(F.explode_outer(starts).alias("start"), by, "n")
    return _with_bounds(held.groupBy("start", by).agg(F.sum("n").alias("n_events")), by, length)


def _with_bounds(windows: DataFrame, by: str, length: int) -> DataFrame:
    return windows.select(
        from_micros(F.col("start")).alias("window_start"),
        from_micros(F.col("start") + F.lit(length)).alias("window_end"),
        by,
        "n_events",
    )
