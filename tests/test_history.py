"""Event history operators against brute force, with ties, nulls and large keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brindle.operators import history
from brindle.operators.running import large_keys

SCHEMA = "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, value double"
START = datetime(2024, 3, 1)


def random_events(seed: int, n: int = 120) -> list[tuple]:
    """One user has a third of the rows, a third of those at one instant."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        user = 1 if draw.random() < 0.35 else draw.choice([2, 3, 4, None])
        ts = START + timedelta(minutes=draw.randrange(0, 60 * 24 * 20, 30))
        if user == 1 and draw.random() < 0.35:
            ts = START + timedelta(days=5)
        if draw.random() < 0.04:
            ts = None
        value = None if draw.random() < 0.1 else draw.randrange(1, 10_000) / 100
        rows.append((i, user, ts, draw.choice(["view", "purchase", "click"]), value))
    return rows


def by_id(frame, column="event_id"):
    return {row[column]: row for row in frame.collect()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("min_large", [0, 20, 10**6])
def test_trailing_features(spark, seed, min_large):
    events = random_events(seed)
    got = by_id(
        history.trailing_features(
            spark.createDataFrame(events, SCHEMA), span="3 days", min_large=min_large
        )
    )
    assert len(got) == len(events)
    for event_id, user, ts, _, _ in events:
        past = [
            e
            for e in events
            if e[1] == user
            and ts is not None
            and e[2] is not None
            and ts - timedelta(days=3) <= e[2] < ts
        ]
        row = got[event_id]
        assert (row.user_id, row.ts) == (user, ts)
        assert row.n_before == len(past)
        assert row.sum_before == pytest.approx(sum(e[4] or 0 for e in past), abs=1e-9)


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("min_large", [0, 20, 10**6])
def test_as_of_feature(spark, seed, min_large):
    events = random_events(seed)
    got = by_id(
        history.as_of_feature(
            spark.createDataFrame(events, SCHEMA),
            F.col("event_type") == "purchase",
            F.col("event_type") == "view",
            min_large=min_large,
        )
    )
    purchases = [e for e in events if e[3] == "purchase"]
    assert set(got) == {e[0] for e in purchases}
    for event_id, user, ts, _, _ in purchases:
        views = [
            e
            for e in events
            if e[3] == "view" and e[1] == user and ts and e[2] is not None and e[2] < ts
        ]
        latest = max(views, key=lambda e: (e[2], e[0]), default=(None,) * 5)
        row = got[event_id]
        assert (row.feature_event_id, row.feature_ts, row.feature_value) == (
            latest[0],
            latest[2],
            latest[4],
        )


@pytest.mark.parametrize("gap_minutes", [30, 60, 600])
def test_session_features(spark, gap_minutes):
    events = [e for e in random_events(5, 300) if e[2] is not None]
    gap = timedelta(minutes=gap_minutes)
    want = []
    for user in {e[1] for e in events}:
        session = []
        for event in sorted((e for e in events if e[1] == user), key=lambda e: (e[2], e[0])):
            if session and event[2] - session[-1][2] > gap:
                want.append((user, session))
                session = []
            session.append(event)
        want.append((user, session))
    expected = {
        (user, s[0][2], s[-1][2], len(s), len({e[3] for e in s})) for user, s in want
    }
    got = history.session_features(
        spark.createDataFrame(events, SCHEMA), gap=f"{gap_minutes} minutes"
    )
    assert {tuple(row) for row in got.collect()} == expected
    assert got.count() == len(want)


def test_gap_exactly_at_the_limit_keeps_the_session(spark):
    moments = [START, START + timedelta(hours=12), START + timedelta(hours=24, microseconds=1)]
    rows = [(i, 1, ts, "view", 1.0) for i, ts in enumerate(moments)]
    got = history.session_features(spark.createDataFrame(rows, SCHEMA), gap="12 hours")
    assert sorted(r.n_events for r in got.collect()) == [1, 2]


def test_large_keys_lists_null_and_none(spark):
    rows = [(i, None if i < 6 else 7 + i % 2, START, "view", 1.0) for i in range(10)]
    events = spark.createDataFrame(rows, SCHEMA)
    assert [r.user_id for r in large_keys(events, "user_id", 5).collect()] == [None]
    assert large_keys(events, "user_id", 6) is None


def test_as_of_over_two_tables(spark):
    prices = spark.createDataFrame(
        [(1, 7, START, 10.0), (2, 7, START + timedelta(hours=2), 20.0)],
        "id bigint, item bigint, ts timestamp_ntz, price double",
    )
    sales = spark.createDataFrame(
        [(10, 7, START + timedelta(hours=2)), (11, 7, START + timedelta(hours=3))],
        "id bigint, item bigint, ts timestamp_ntz",
    )
    both = prices.withColumn("is_sale", F.lit(False)).unionByName(
        sales.withColumn("is_sale", F.lit(True)), allowMissingColumns=True
    )
    got = history.as_of_feature(
        both, F.col("is_sale"), ~F.col("is_sale"), key="item", order="id", value="price"
    )
    # the price set at the moment of a sale comes too late for it
    assert {r.id: r.feature_value for r in got.collect()} == {10: 10.0, 11: 20.0}
