"""Streaming forms of the event jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_window_counts(
    events: DataFrame,
    ts: str = "ts",
    by: str = "event_type",
    size: str = "1 day",
    slide: str | None = None,
    delay: str = "1 hour",
) -> DataFrame:
    """Rows per closed time window and ``by``; rows later than ``delay`` are dropped, and so
    are rows without a time, which no watermark passes.

    Counts merge within a task before the shuffle, so a hot ``by`` is one row per
    window and task.
    """
    return (
        events.select(F.col(ts).cast("timestamp").alias("_ts"), by)
        .withWatermark("_ts", delay)
        .groupBy(F.window("_ts", size, slide).alias("w"), by)
        .agg(F.count("*").alias("n_events"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            by,
            "n_events",
        )
    )


def open_windows(spark: SparkSession, state: str, by: str = "event_type") -> DataFrame:
    """The counts of ``stream_window_counts`` that a stream has not closed yet.

    Read from the state in the checkpoint folder ``state``. Together with the closed
    windows they account for every row that came in time.
    """
    return spark.read.format("statestore").load(state).select(
        F.col("key").getField("window").getField("start").cast("timestamp_ntz").alias("window_start"),
        F.col("key").getField("window").getField("end").cast("timestamp_ntz").alias("window_end"),
        F.col("key").getField(by).alias(by),
        F.col("value").getField("count").alias("n_events"),
    )


def stream_dedup(
    events: DataFrame, id_col: str = "event_id", ts: str = "ts", delay: str = "1 hour"
) -> DataFrame:
    """The first copy of each id; copies may arrive up to ``delay`` apart.

    Spark's own deduplication and nothing before it: which copy is the first, and which
    is too late, depends on the watermark alone. Rows with a null id are copies of each
    other.
    """
    return (
        events.withColumn("_ts", F.col(ts).cast("timestamp"))
        .withWatermark("_ts", delay)
        .dropDuplicatesWithinWatermark([id_col])
        .drop("_ts")
    )
