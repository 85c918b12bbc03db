"""Running a stream to the end of its present input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from brindle.sources.scratch import new_place


# Progress reports that a query keeps, and seconds between two looks at them.
KEPT, EVERY = 1000, 1
_RETENTION = "spark.sql.streaming.numRecentProgressUpdates"


def _dropped(query: StreamingQuery) -> int:
    """Rows that all batches of a query dropped as too late, read while it runs."""
    by_batch: dict[int, int] = {}
    while True:
        done = query.awaitTermination(EVERY)
        for batch in query.recentProgress:
            rows = sum(operator["numRowsDroppedByWatermark"] for operator in batch["stateOperators"])
            by_batch[batch["batchId"]] = max(rows, by_batch.get(batch["batchId"], 0))
        if done:
            break
    if by_batch and len(by_batch) != max(by_batch) - min(by_batch) + 1:
        raise RuntimeError("reports of some batches are lost, so late rows cannot be ruled out")
    return sum(by_batch.values())


class _Mark:
    """An empty file in a place, by the place's own file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._path.getFileSystem(context._jsc.hadoopConfiguration())

    def set(self) -> bool:
        """False if it was there before."""
        return self._files.createNewFile(self._path)

    def remove(self) -> None:
        self._files.delete(self._path, False)


def run_to_table(
    stream: DataFrame, purpose: str, place: str | None = None, late: str = "drop"
) -> DataFrame:
    """Process all files there are, then return the written table.

    Output (``{place}/table``) and state (``{place}/state``) live in ``place``, a fresh
    one in the shared folder unless the caller names it. A call with the same ``place``
    continues: files that it has seen are not read again, so each counts exactly once.

    Rows behind the watermark are dropped, as Spark does; with ``late="raise"`` any such
    row is an error instead. Output and state are committed by then, so the place keeps
    a mark, as it does if the run ends in between, and later calls with ``late="raise"``
    refuse it: what it holds may lack rows.
    """
    spark = stream.sparkSession
    place = place or new_place(spark, purpose)
    mark = _Mark(spark, f"{place}/unproven")
    if late == "raise" and not mark.set():
        raise RuntimeError(f"an earlier run to {place} lost late rows or did not end")
    kept = spark.conf.get(_RETENTION)
    spark.conf.set(_RETENTION, KEPT)
    try:
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{place}/table")
            .option("checkpointLocation", f"{place}/state")
            .trigger(availableNow=True)
            .start()
        )
        dropped = _dropped(query)
    finally:
        spark.conf.set(_RETENTION, kept)
    if dropped and late == "raise":
        raise RuntimeError(f"{dropped} rows came too late for the watermark")
    if late == "raise":
        mark.remove()
    elif dropped:
        mark.set()
    return spark.read.schema(stream.schema).parquet(f"{place}/table")
