from datetime import datetime, timedelta

import pytest

from brindle.functions import interval_micros
from brindle.operators import counts

START = datetime(2024, 3, 1)


def test_customer_without_orders_is_kept(spark):
    customers = spark.createDataFrame([(1,), (2,)], "c_custkey bigint")
    orders = spark.createDataFrame(
        [(10, 1, 0.1, START), (11, 1, 0.2, START + timedelta(days=1)), (12, None, 5.0, START)],
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    )
    got = {r.c_custkey: tuple(r)[1:] for r in counts.order_features(customers, orders).collect()}
    assert got == {
        1: (2, 0.3, 0.15, START + timedelta(days=1)),
        2: (0, 0.0, None, None),
    }


def test_event_counts_of_missing_types_and_values(spark):
    events = spark.createDataFrame(
        [(1, "view", 1.25), (1, "view", None), (1, "other", 9.0), (2, None, 3.0)],
        "user_id bigint, event_type string, value double",
    )
    got = {r.user_id: r for r in counts.event_counts(events, "user_id", ["view", "click"]).collect()}
    assert (got[1].n_view, got[1].sum_view, got[1].n_click, got[1].sum_click) == (2, 1.25, 0, 0.0)
    assert (got[2].n_view, got[2].sum_view) == (0, 0.0)


def test_sums_do_not_depend_on_partitions(spark):
    rows = [(1, "view", 0.1 * (i % 7)) for i in range(1000)]
    events = spark.createDataFrame(rows, "user_id bigint, event_type string, value double")
    sums = {
        counts.event_counts(events.repartition(n), "user_id", ["view"]).first().sum_view
        for n in (1, 3, 16)
    }
    assert len(sums) == 1


def test_sliding_windows_that_do_not_divide_the_size(spark):
    moments = [START + timedelta(minutes=7 * i) for i in range(200)]
    events = spark.createDataFrame([(m, "a") for m in moments], "ts timestamp_ntz, kind string")
    got = counts.window_counts(events, "ts", "kind", "90 minutes", "40 minutes").collect()
    step, size = timedelta(minutes=40), timedelta(minutes=90)
    epoch = datetime(1970, 1, 1)
    expected = {}
    for moment in moments:
        start = epoch + (moment - epoch) // step * step
        while start + size > moment:
            expected[start] = expected.get(start, 0) + 1
            start -= step
    assert {r.window_start: r.n_events for r in got} == expected
    assert all(r.window_end - r.window_start == size for r in got)


def test_interval_micros():
    assert interval_micros("12 hours") == 12 * 3_600_000_000
    assert interval_micros("1 day") == 86_400_000_000
    for bad in ("0 days", "soon", "1 month", "-1 day"):
        try:
            interval_micros(bad)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_small_values_are_summed_and_what_does_not_fit_raises(spark):
    events = spark.range(1000).selectExpr("1L as user_id", "'view' as event_type", "0.004D as value")
    assert counts.event_counts(events, "user_id", ["view"]).first().sum_view == 4.0
    for value, digits in ((0.004, 2), (float("inf"), 6), (1e30, 6)):
        bad = spark.createDataFrame([(1, "view", value)], "user_id bigint, event_type string, value double")
        with pytest.raises(Exception, match="digits"):
            counts.event_counts(bad, "user_id", ["view"], digits=digits).collect()


def test_types_that_are_not_listed_count_as_other(spark):
    events = spark.createDataFrame(
        [(1, "view", 1.5), (1, "refund", 2.0), (1, None, 4.0)], "user_id bigint, event_type string, value double"
    )
    got = counts.event_counts(events, "user_id", ["view"]).first()
    assert (got.n_view, got.n_other, got.sum_other) == (1, 2, 6.0)


def test_rows_without_a_time_are_counted(spark):
    events = spark.createDataFrame([(START, "a"), (None, "a"), (None, "a")], "ts timestamp_ntz, kind string")
    for slide in (None, "6 hours"):
        got = counts.window_counts(events, "ts", "kind", "1 day", slide).where("window_start is null")
        assert [(r.window_end, r.n_events) for r in got.collect()] == [(None, 2)]
