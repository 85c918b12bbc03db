"""Reading the tables, bounded samples and cuts of lineage."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.text import bounded_batches
from brindle.sources.scratch import new_place


_ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Settings for tasks in Python: small batches, and this package on their path.

    Spark's own Bloom filters (of a fixed size at most) thin out the larger side of a
    join before its shuffle also where a table has less than 10 GB. The files of a
    query's shuffles go when it ends, as what later queries need is a written table.
    """
    bounded_batches(spark)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "16m")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "1g")
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{base}/{name}.parquet")


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` from a table in the shared folder: worked out once, and a lost
    executor then costs a read."""
    place = new_place(rows.sparkSession, purpose)
    rows.write.parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)


def remainder(key: Column, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``."""
    return F.crc32(key.cast("string")) % of


def bounded(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those whose key has the smallest hash."""
    return rows.orderBy(F.xxhash64(F.lit("sample"), F.col(key)), F.col(key)).limit(most)


def put_bytes(spark: SparkSession, purpose: str, data: bytes) -> str:
    """Write a small file to the shared folder, through the folder's own file system."""
    place = new_place(spark, purpose)
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(place)
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return place
