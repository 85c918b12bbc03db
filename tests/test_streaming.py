"""Streams fed file by file: late, early and repeated events."""

import os
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from brindle.operators import counts
from brindle.sources import scratch
from brindle.sources.tables import read, read_stream
from brindle.streaming.events import stream_dedup, stream_window_counts
from brindle.streaming.sink import run_to_table

SCHEMA = "event_id bigint, ts timestamp_ntz, event_type string"
START = datetime(2024, 3, 1)


def feed(spark, folder, batches):
    """One file per batch, read in order of their names' age, one at a time."""
    stored = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("event_type", pa.string())])
    for i, batch in enumerate(batches):
        rows = [
            {"event_id": id_, "ts": START + timedelta(hours=hour), "event_type": kind}
            for id_, hour, kind in batch
        ]
        path = f"{folder}/events-{i}.parquet"
        pq.write_table(pa.Table.from_pylist(rows, stored), path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return read_stream(spark, str(folder), "events", SCHEMA, files_per_trigger=1)


def test_late_rows_are_dropped_and_open_windows_held_back(spark, tmp_path):
    stream = feed(
        spark,
        tmp_path,
        [
            [(1, 1, "view"), (2, 2, "view")],
            [(3, 23.5, "view"), (4, 24.5, "click")],  # within the delay: day one still open
            [(5, 23.8, "view"), (6, 30, "click")],  # out of order but in time
            [(9, 31, "click")],  # Spark filters by the watermark of one batch before
            [(7, 3, "view"), (8, 60, "click")],  # 7 is a day late
        ],
    )
    got = run_to_table(stream_window_counts(stream), "test-windows")
    assert {(r.window_start, r.event_type, r.n_events) for r in got.collect()} == {
        (START, "view", 4),
        (START + timedelta(days=1), "click", 3),
    }


def test_first_copy_of_each_id_over_files(spark, tmp_path):
    stream = feed(
        spark,
        tmp_path,
        [
            [(1, 1, "view"), (1, 1, "view"), (2, 1.1, "view")],
            [(1, 1, "view"), (3, 1.2, "click")],
            [(2, 1.1, "view"), (3, 1.2, "click"), (4, 1.5, "view")],
        ],
    )
    got = run_to_table(stream_dedup(stream), "test-dedup").collect()
    assert sorted(r.event_id for r in got) == [1, 2, 3, 4]
    assert {r.ts for r in got if r.event_id == 2} == {START + timedelta(hours=1.1)}


@pytest.mark.parametrize("slide", [None, "6 hours"])
def test_stream_equals_batch_on_closed_windows(spark, slide):
    base = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{base}/events.parquet")
    streamed = run_to_table(
        stream_window_counts(read_stream(spark, base, "events"), slide=slide), "test-equal"
    )
    end = events.agg({"ts": "max"}).first()[0] - timedelta(hours=1)
    batch = counts.window_counts(events, "ts", "event_type", "1 day", slide)
    assert sorted(map(tuple, streamed.collect())) == sorted(
        map(tuple, batch.where(batch.window_end <= end).collect())
    )


class FakeSession:
    """Only what ``shared_folder`` asks a session for."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master


def test_shared_folder():
    assert scratch.shared_folder(FakeSession("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert scratch.new_place(FakeSession("yarn", "hdfs://x/y"), "a").startswith("hdfs://x/y/a-")
    local = FakeSession("local[2]")
    assert scratch.shared_folder(local) == scratch.shared_folder(local)
    with pytest.raises(RuntimeError):
        scratch.shared_folder(FakeSession("spark://host:7077"))


def test_stream_of_a_table_that_is_a_folder(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    events.limit(10).write.parquet(f"{tmp_path}/eventsother.parquet")
    streamed = run_to_table(read_stream(spark, str(tmp_path), "events"), "test-folder")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, events.collect()))


def test_ids_beyond_doubles_and_a_null_are_kept_apart(spark, tmp_path):
    stream = feed(spark, tmp_path, [[(2**53, 1, "view"), (2**53 + 1, 1, "view"), (None, 1, "view")]])
    got = run_to_table(stream_dedup(stream), "test-dedup").collect()
    assert {r.event_id for r in got} == {2**53, 2**53 + 1, None}


def test_a_late_copy_does_not_take_the_on_time_one_with_it(spark, tmp_path):
    stream = feed(
        spark,
        tmp_path,
        [[(1, 30, "view")], [(2, 31, "view")], [(7, 3, "view"), (7, 31, "click")], [(8, 32, "view")]],
    )
    got = run_to_table(stream_dedup(stream), "test-dedup").collect()
    assert sorted((r.event_id, r.event_type) for r in got) == [
        (1, "view"), (2, "view"), (7, "click"), (8, "view")
    ]


def test_a_named_place_continues(spark, tmp_path):
    (tmp_path / "in").mkdir()
    place = f"{tmp_path}/place"
    stream = feed(spark, tmp_path / "in", [[(1, 1, "view")]])
    assert run_to_table(stream_dedup(stream), "x", place).count() == 1
    extra = pa.table({"event_id": [1, 2], "ts": [START + timedelta(hours=1)] * 2, "event_type": ["view"] * 2})
    pq.write_table(extra, tmp_path / "in" / "events-late.parquet")
    got = run_to_table(stream_dedup(read_stream(spark, f"{tmp_path}/in", "events", SCHEMA)), "x", place)
    assert sorted(r.event_id for r in got.collect()) == [1, 2]


def test_late_rows_can_be_an_error(spark, tmp_path):
    stream = feed(
        spark, tmp_path, [[(1, 30, "view")], [(2, 31, "view")], [(3, 60, "view")], [(4, 1, "view")]]
    )
    with pytest.raises(RuntimeError, match="too late"):
        run_to_table(stream_window_counts(stream), "test-late", late="raise")


def test_a_place_that_lost_rows_is_refused(spark, tmp_path):
    (tmp_path / "in").mkdir()
    batches = [[(1, 30, "view")], [(2, 31, "view")], [(3, 60, "view")], [(4, 1, "view")]]
    stream, place = feed(spark, tmp_path / "in", batches), f"file://{tmp_path}/place"
    with pytest.raises(RuntimeError, match="too late"):
        run_to_table(stream_window_counts(stream), "test-late", place, late="raise")
    with pytest.raises(RuntimeError, match="earlier run"):
        run_to_table(stream_window_counts(stream), "test-late", place, late="raise")
    assert run_to_table(stream_window_counts(stream), "test-late", place).count() == 1


def test_a_clean_place_goes_on(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream, place = feed(spark, tmp_path / "in", [[(1, 30, "view")], [(2, 60, "view")]]), f"file://{tmp_path}/place"
    for _ in range(2):
        run_to_table(stream_window_counts(stream), "test-late", place, late="raise")


def test_batch_and_stream_read_the_same_files(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.limit(100).write.parquet(f"{tmp_path}/events.parquet")
    events.limit(50).write.parquet(f"{tmp_path}/events-more.parquet")
    streamed = run_to_table(read_stream(spark, str(tmp_path), "events"), "test-files")
    assert read(spark, str(tmp_path), "events").count() == streamed.count() == 150


def test_a_folder_on_one_machine_is_refused_on_a_cluster():
    with pytest.raises(RuntimeError):
        scratch.shared_folder(FakeSession("yarn", "file:///tmp/checkpoints"))


def test_late_rows_of_early_batches_are_seen(spark, tmp_path):
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    late = [[(1, 1, "view")], [(2, 100, "view")], [(3, 101, "view")], [(4, 2, "view")]]
    stream = feed(spark, tmp_path, late + [[(5 + k, 102 + k, "view")] for k in range(4)])
    spark.conf.set(name, 2)
    try:
        with pytest.raises(RuntimeError, match="too late"):
            run_to_table(stream_window_counts(stream), "test-late", late="raise")
        assert spark.conf.get(name) == "2"
    finally:
        spark.conf.set(name, before)
