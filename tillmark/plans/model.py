"""The stored star model: what a refresh writes and what report queries read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.months import year_month
from tillmark.operators import star
from tillmark.plans.measure_store import MeasureStore, open_store, refresh_store
from tillmark.sources.versions import current_version, write_version


@dataclass(frozen=True)
class StarModel:
    fact: DataFrame
    dates: DataFrame
    products: DataFrame
    customers: DataFrame
    countries: DataFrame
    measures: MeasureStore


def refresh_model(fact: DataFrame, path: str) -> StarModel:
    """Write the fact by month, the four dimensions derived from it, and the measures' grain, as a new version.

    The rebalance hint lets Spark split the files of a heavy month and merge those of a
    light one. Dimensions read the stored columns back, so the source is read once. Readers see
    the model before until all of the new one is written.
    """
    spark = fact.sparkSession

    def write(folder: str) -> None:
        modelled = star.model_fact(fact).withColumn("YearMonth", year_month(F.col("InvoiceDate")))
        modelled.hint("rebalance", "YearMonth").write.partitionBy("YearMonth").parquet(f"{folder}/fact")
        stored = spark.read.parquet(f"{folder}/fact")
        for name, dimension in (
            ("dates", star.dim_date(stored)), ("products", star.dim_product(stored)),
            ("customers", star.dim_customer(stored)), ("countries", star.dim_country(stored)),
        ):
            dimension.write.parquet(f"{folder}/{name}")
        refresh_store(stored, f"{folder}/measures")

    write_version(spark, path, write)
    return open_model(spark, path)


def open_model(spark: SparkSession, path: str) -> StarModel:
    """Read a stored model; ``fact`` carries the partition column YearMonth as well."""
    folder = current_version(spark, path)
    if folder is None:
        raise FileNotFoundError(f"model_not_found: {path}")
    fact = spark.read.parquet(f"{folder}/fact")
    dimensions = [spark.read.parquet(f"{folder}/{name}") for name in ("dates", "products", "customers", "countries")]
    return StarModel(fact, *dimensions, open_store(spark, f"{folder}/measures"))
