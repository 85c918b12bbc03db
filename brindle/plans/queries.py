"""The registered queries: which tables each operator runs on."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators import counts, evaluation, fitted, history, model
from brindle.sources.scratch import new_place
from brindle.sources.tables import read, read_stream
from brindle.streaming.events import open_windows, stream_dedup, stream_window_counts
from brindle.streaming.sink import run_to_table

Query = Callable[[SparkSession, str], DataFrame]

# Statistics are fitted on what lies before these days and applied to all rows.
ORDERS_FITTED_BEFORE = datetime(1999, 1, 1)
EVENTS_FITTED_BEFORE = datetime(2024, 1, 22)

# Keys with more events than this are cut into slots in the *_large_keys queries.
FEW_EVENTS = 20


def _before(col: str, moment: datetime) -> Column:
    return F.col(col) < F.lit(moment).cast("timestamp_ntz")


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def order_features(spark: SparkSession, base: str) -> DataFrame:
    return counts.order_features(read(spark, base, "customer"), read(spark, base, "orders"))


def event_counts(spark: SparkSession, base: str) -> DataFrame:
    return counts.event_counts(read(spark, base, "events"), "user_id", model.EVENT_TYPES)


def window_counts_tumbling(spark: SparkSession, base: str) -> DataFrame:
    return counts.window_counts(read(spark, base, "events"), "ts", "event_type", "1 day")


def window_counts_sliding(spark: SparkSession, base: str) -> DataFrame:
    return counts.window_counts(
        read(spark, base, "events"), "ts", "event_type", "1 day", "6 hours"
    )


def trailing_features(spark: SparkSession, base: str) -> DataFrame:
    return history.trailing_features(read(spark, base, "events"))


def trailing_features_large_keys(spark: SparkSession, base: str) -> DataFrame:
    return history.trailing_features(read(spark, base, "events"), min_large=FEW_EVENTS)


def as_of_feature(spark: SparkSession, base: str) -> DataFrame:
    return history.as_of_feature(read(spark, base, "events"), _is("purchase"), _is("view"))


def as_of_feature_large_keys(spark: SparkSession, base: str) -> DataFrame:
    return history.as_of_feature(
        read(spark, base, "events"), _is("purchase"), _is("view"), min_large=FEW_EVENTS
    )


def session_features(spark: SparkSession, base: str) -> DataFrame:
    return history.session_features(read(spark, base, "events"))


def standardised_prices(spark: SparkSession, base: str) -> DataFrame:
    return fitted.standardise(
        read(spark, base, "orders"),
        ["o_totalprice"],
        _before("o_orderdate", ORDERS_FITTED_BEFORE),
        ["o_orderkey"],
        digits=2,
    )


def quantile_bins(spark: SparkSession, base: str) -> DataFrame:
    return fitted.quantile_bins(
        read(spark, base, "orders"),
        "o_totalprice",
        _before("o_orderdate", ORDERS_FITTED_BEFORE),
        ["o_orderkey"],
        digits=2,
    )


def smoothed_return_rates(spark: SparkSession, base: str) -> DataFrame:
    return fitted.smoothed_means(
        read(spark, base, "lineitem"),
        "l_suppkey",
        F.col("l_returnflag") == "R",
        _before("l_shipdate", ORDERS_FITTED_BEFORE),
        ["l_orderkey", "l_linenumber", "l_partkey"],
    )


def binary_metrics(spark: SparkSession, base: str) -> DataFrame:
    """How well the price of a line tells whether it was returned."""
    return evaluation.binary_metrics(
        read(spark, base, "lineitem"),
        F.col("l_extendedprice"),
        F.col("l_returnflag") == "R",
        cut=50_000.0,
    )


def price_drift(spark: SparkSession, base: str) -> DataFrame:
    early = _before("o_orderdate", ORDERS_FITTED_BEFORE)
    return evaluation.drift(read(spark, base, "orders"), "o_totalprice", early, ~early, digits=2)


def purchase_forecast(spark: SparkSession, base: str) -> DataFrame:
    days = model.daily_features(read(spark, base, "events"))
    return model.naive_bayes(
        days,
        [f"n_{t}" for t in model.EVENT_TYPES],
        _before("day", EVENTS_FITTED_BEFORE),
        ["user_id", "day"],
    )


def purchase_forecast_metrics(spark: SparkSession, base: str) -> DataFrame:
    return evaluation.binary_metrics(
        purchase_forecast(spark, base),
        F.col("log_odds_e9"),
        F.col("label") == 1,
        cut=-6e8,  # about 35 %, the share of days before a purchase
    )


def purchase_forecast_inputs(spark: SparkSession, base: str) -> DataFrame:
    return model.daily_features(read(spark, base, "events"))


def streamed_window_counts(spark: SparkSession, base: str) -> DataFrame:
    """Closed windows and those still open: every event counts."""
    place = new_place(spark, "window-counts")
    counts_ = stream_window_counts(read_stream(spark, base, "events"))
    closed = run_to_table(counts_, "window-counts", place, late="raise")
    return closed.unionByName(open_windows(spark, f"{place}/state"))


def streamed_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Every event delivered twice; one copy of each must come out."""
    events = read_stream(spark, base, "events")
    twice = events.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("_copy"))
    return run_to_table(stream_dedup(twice.drop("_copy")), "dedup")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        order_features,
        event_counts,
        window_counts_tumbling,
        window_counts_sliding,
        trailing_features,
        trailing_features_large_keys,
        as_of_feature,
        as_of_feature_large_keys,
        session_features,
        standardised_prices,
        quantile_bins,
        smoothed_return_rates,
        binary_metrics,
        price_drift,
        purchase_forecast_inputs,
        purchase_forecast,
        purchase_forecast_metrics,
        streamed_window_counts,
        streamed_dedup,
    )
}
