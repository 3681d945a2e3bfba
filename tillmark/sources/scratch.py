"""Where jobs keep intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder of the cluster.

    The folder is ``spark.checkpoint.dir``, else the checkpoint folder set on the context.
    Where neither is set, a local master (as in tests) gets a local temporary folder; on a
    cluster executors could not see one, so the call fails.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tillmark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(frame: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The frame written below the scratch folder and read back; its shuffle files go."""
    path = scratch_path(frame.sparkSession, name)
    with shuffles_dropped(frame.sparkSession):
        frame.write.parquet(path, compression=codec)
    return frame.sparkSession.read.parquet(path)


def source_bytes(frame: DataFrame) -> int:
    """The size of all files that a frame reads, whatever columns and rows it takes; 0 without files."""
    jvm, conf = frame.sparkSession.sparkContext._jvm, frame.sparkSession.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)) for file in frame.inputFiles()]
    return sum(path.getFileSystem(conf).getFileStatus(path).getLen() for path in paths)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Removes a path that ``scratch_path`` gave, or a folder below one; what is gone already is no error."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(*frames: DataFrame) -> None:
    """Removes the folders of stored frames that nothing reads any more."""
    for frame in frames:
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            drop_scratch(frame.sparkSession, folder)
