"""What the plans must and must not contain, whatever the data's size."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from brindle.operators import evaluation, history
from brindle.plans.queries import QUERIES
from brindle.sources.tables import read_stream
from brindle.streaming.events import stream_dedup, stream_window_counts

BASE = "/root/testdata/sf0.001"


def plan(frame) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(query(spark, BASE)) for name, query in QUERIES.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(plans, name):
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "MapInArrow"):
        assert word not in plans[name]


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("order_features", 1),  # the aggregate's own partitioning serves the join
        ("event_counts", 1),
        ("window_counts_tumbling", 1),
        ("window_counts_sliding", 2),
        ("trailing_features", 1),
        ("as_of_feature", 1),
        ("session_features", 2),
        ("standardised_prices", 0),
        ("quantile_bins", 0),
        ("smoothed_return_rates", 0),
        ("price_drift", 1),
    ],
)
def test_shuffles(plans, name, shuffles):
    assert plans[name].count("Arguments: hashpartitioning") == shuffles


@pytest.mark.parametrize(
    "name, columns",
    [
        ("event_counts", "user_id:bigint,event_type:string,value:double"),
        ("trailing_features", "event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double"),
        ("session_features", "ts:timestamp_ntz,user_id:bigint,event_type:string"),
        ("quantile_bins", "o_orderkey:bigint,o_totalprice:double"),
    ],
)
def test_scan_reads_only_the_needed_columns(plans, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plans[name]


def test_score_counts_are_combined_before_the_one_shuffle(spark):
    lines = spark.read.parquet(f"{BASE}/lineitem.parquet")
    text = plan(evaluation.score_counts(lines, F.col("l_extendedprice"), F.col("l_returnflag") == "R"))
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in text
    assert text.count("Arguments: hashpartitioning") == 1 and "partial_" in text


def test_no_python_in_the_streams(spark):
    events = read_stream(spark, BASE, "events")
    for stream in (stream_dedup(events), stream_window_counts(events)):
        text = plan(stream)
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_filter_reaches_the_scan(plans):
    assert "PushedFilters: [Or(EqualTo(event_type,purchase),EqualTo(event_type,view))]" in (
        plans["as_of_feature"]
    )


def test_rows_are_combined_before_the_shuffle(plans):
    for name in ("order_features", "event_counts", "window_counts_tumbling", "session_features"):
        assert "partial_" in plans[name]


@pytest.fixture
def no_runtime_merging(spark):
    """Small partitions stay apart, as large ones would."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_spreads_over_tasks(spark, no_runtime_merging):
    """Half of all rows in one key: every task gets a part of them."""
    base = spark.read.parquet(f"{BASE}/events.parquet")
    events = base.withColumn(
        "user_id", F.when(F.col("event_id") % 2 == 0, F.lit(1)).otherwise(F.col("user_id"))
    )
    for min_large, largest_share in ((100, 0.3), (10**6, 1.0)):
        counted = (
            history.trailing_features(events, min_large=min_large)
            .groupBy("user_id", F.spark_partition_id().alias("task"))
            .count()
            .where("user_id = 1")
            .collect()
        )
        sizes = [row["count"] for row in counted]
        assert sum(sizes) >= 500
        assert max(sizes) / sum(sizes) <= largest_share
        if min_large == 100:
            assert len(sizes) == 8
