"""Writers that refuse to overwrite by accident, and evidence files."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.sources.versions import current_version, write_version


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that :func:`guarded_table_write` wrote."""
    folder = current_version(spark, path)
    if folder is None:
        raise FileNotFoundError(f"table_not_found: {path}")
    return spark.read.parquet(folder)


def holds_rows(spark: SparkSession, path: str) -> bool:
    """Whether a table exists at the path and has any row."""
    try:
        return not read_table(spark, path).isEmpty()
    except FileNotFoundError:
        return False
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def guarded_table_write(table: DataFrame, path: str, replace: bool = False, partition_by: tuple[str, ...] = ()) -> None:
    """Write a table; one that already holds rows is replaced only on request, and then in one step.

    ``table`` may read the version that it replaces.
    """
    spark = table.sparkSession
    if not replace and holds_rows(spark, path):
        raise ValueError("raw_table_not_empty_use_replace")
    writer = table.write.partitionBy(*partition_by) if partition_by else table.write
    write_version(spark, path, writer.parquet)


def write_load(normalised: DataFrame, path: str, replace: bool = False) -> None:
    """Loaded and rejected rows in one pass over the source, as two partitions of one table."""
    status = F.when(F.col("reject_code").isNull(), "loaded").otherwise("rejected")
    guarded_table_write(normalised.withColumn("load_status", status), path, replace, ("load_status",))


def read_load(spark: SparkSession, path: str, status: str) -> DataFrame:
    """Loaded or rejected rows of a written load; only that partition is read."""
    return read_table(spark, path).filter(F.col("load_status") == status).drop("load_status")


def write_evidence(results: DataFrame, path: str, name: str, failed: DataFrame | None = None) -> None:
    """JSON results and one status line.

    The status is failed when ``failed`` has any row, passed when it has none, and
    unchecked without ``failed``.
    """
    spark = results.sparkSession
    results.write.mode("overwrite").json(f"{path}/results")
    status = "unchecked" if failed is None else "passed" if failed.isEmpty() else "failed"
    summary = spark.read.json(f"{path}/results", schema=results.schema).agg(F.count("*").alias("result_count"))
    summary.select(
        F.lit(name).alias("name"), F.lit(status).alias("status"), "result_count",
        F.lit(datetime.now(timezone.utc).isoformat()).alias("generated_at"),
    ).write.mode("overwrite").json(f"{path}/summary")
