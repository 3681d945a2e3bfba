"""Running numbers over rows in a stated order, without a sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.sources.scratch import scratch_path

_PLACE = (1 << 33) - 1


def with_running_number(rows: DataFrame, order: Sequence[str | Column], name: str = "row", first: int = 1) -> DataFrame:
    """``rows`` with a number that runs on from ``first`` in the order of some columns.

    Rows are dealt by ranges of the order, sorted within their range and stored once with their
    place in it; a window over one row per range then turns places into numbers. Stored places
    don't change when an executor is lost. The order should tell rows apart: equal rows are
    numbered in any order, and all rows of one value share a task.
    """
    spark = rows.sparkSession
    kept = rows.columns
    path = scratch_path(spark, "numbered")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("|at", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    part, place = F.shiftright("|at", 33), F.col("|at").bitwiseAND(F.lit(_PLACE))
    counts = stored.groupBy(part.alias("|part")).agg(F.count("*").alias("|size"))
    before = Window.orderBy("|part").rowsBetween(Window.unboundedPreceding, -1)
    # One short row per range; Spark broadcasts it by its measured size.
    offsets = counts.select("|part", F.coalesce(F.sum("|size").over(before), F.lit(0)).alias("|before"))
    joined = stored.withColumn("|part", part).join(offsets, "|part")
    return joined.select(*[F.col(f"`{column}`") for column in kept], (F.col("|before") + place + first).alias(name))
