"""Tables and models that are replaced in one step.

A path holds numbered folders and a pointer to the one that counts. A new version is written
beside the others, and the pointer moves once everything lies there; a write that fails or
is killed leaves the old version in place, also when it reads that version itself. The version
before the last stays for those that still read it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tillmark.sources.scratch import drop_scratch

POINTER, FOLDER = "_current", "_versions"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that counts, None where there is none."""
    jvm, pointer, files = _hadoop(spark, f"{path}/{POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        name = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path}/{FOLDER}/{name}"


def _point(spark: SparkSession, path: str, name: str) -> None:
    """Moves the pointer by a rename over the old one."""
    jvm, fresh, files = _hadoop(spark, f"{path}/{POINTER}-{name}")
    stream = files.create(fresh, True)
    stream.write(bytearray(name.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    context.rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), over)


def write_version(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Calls ``write`` with a new folder and makes it the version that counts. Returns the folder."""
    before = current_version(spark, path)
    name = uuid.uuid4().hex
    folder = f"{path}/{FOLDER}/{name}"
    write(folder)
    _point(spark, path, name)
    _, versions, files = _hadoop(spark, f"{path}/{FOLDER}")
    kept = {name, before.rsplit("/", 1)[1] if before else name}
    for status in files.listStatus(versions):
        old = status.getPath().getName()
        if old not in kept:
            drop_scratch(spark, f"{path}/{FOLDER}/{old}")
    return folder
