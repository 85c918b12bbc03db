"""Places in the shared folder for stream state, stream output and lineage cuts."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_places: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one in local mode only.

    Off local mode, a folder below the machine's own temporary one is refused: each
    executor would write to its own disk.
    """
    folder = spark.conf.get(_SETTING, None)
    local = spark.sparkContext.master.startswith("local")
    if folder:
        folder = folder.rstrip("/")
        path = folder.removeprefix("file://")
        if not local and f"{path}/".startswith((f"{tempfile.gettempdir()}/", "/tmp/", "/var/tmp/")):
            raise RuntimeError(f"{_SETTING} is on one machine: {folder}")
        return folder
    if not local:
        raise RuntimeError(f"{_SETTING} must name a folder all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="brindle-")


def new_place(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    place = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _places.append(place)
    return place


def remove_places(spark: SparkSession) -> int:
    """Remove all that was written to places given out so far; how many there were.

    Results that have not been written elsewhere read from them and are lost.
    """
    jvm = spark.sparkContext._jvm
    n = 0
    while _places:
        path = jvm.org.apache.hadoop.fs.Path(_places.pop())
        n += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n
