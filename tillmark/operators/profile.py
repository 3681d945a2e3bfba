"""Table and column profiles, and the named anomaly counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.plans.contracts import DESCRIPTION_LIMIT

#: What a source row states, without its number.
BUSINESS_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country")
# Fixed value: what a report shows for a product without a description.
UNKNOWN_PRODUCT = "Unknown Product Description"


def table_profile(table: DataFrame) -> DataFrame:
    """Type, rows, nulls, distinct values and text lengths of every column.

    Cells become (column, value) rows that combine on the map side, so a value that most rows
    share travels once per task; a long value travels as its SHA-256.
    """
    types = dict(table.dtypes)
    cells = table.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in types]).unpivot([], list(types), "column_name", "value")
    size = F.length("value")
    short = F.when(size > 64, F.concat(F.lit("#"), F.sha2("value", 256), size.cast("string"))).otherwise(F.col("value"))
    values = cells.groupBy("column_name", short.alias("value"), size.alias("size")).agg(F.count("*").alias("n"))
    facts = values.groupBy("column_name").agg(
        F.sum("n").alias("row_count"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.count("value").alias("distinct_count"), F.min("size").alias("min_length"), F.max("size").alias("max_length"),
    )
    # A table without rows has a row per column all the same.
    every = table.sparkSession.createDataFrame(list(types.items()), "column_name string, data_type string")
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    return every.join(facts, "column_name", "left").select(
        "column_name", "data_type", zero("row_count"), zero("null_count"), zero("distinct_count"), "min_length", "max_length")


def negative_quantity_mismatch(fact: DataFrame) -> DataFrame:
    """Lines whose sign and cancellation flag disagree; a missing value disagrees with nothing."""
    return fact.filter((F.col("Quantity") < 0) != F.col("IsCancellation"))


def repeated_source_rows(fact: DataFrame, columns: Sequence[str] = BUSINESS_COLUMNS) -> DataFrame:
    """Rows that occur more than once in all of some columns, NULLs alike, and how often.

    Equal rows combine on the map side, so one that makes up much of the table is no hot key.
    """
    return fact.groupBy(*columns).agg(F.count("*").alias("copies")).filter("copies > 1")


def with_product_display(products: DataFrame) -> DataFrame:
    """Products with the name that a report shows where a description is missing."""
    return products.withColumn("ProductDisplay", F.coalesce(F.nullif(F.trim("Description"), F.lit("")), F.lit(UNKNOWN_PRODUCT)))


def description_length_guard(fact: DataFrame, limit: int = DESCRIPTION_LIMIT) -> DataFrame:
    """Longest description and whether it fits."""
    longest = F.max(F.length("Description"))
    return fact.agg(
        F.count("*").alias("row_count"), longest.alias("max_length"),
        (F.coalesce(longest, F.lit(0)) <= limit).alias("passed"),
    )


def date_range_guard(fact: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Lines dated outside the approved period, both ends included."""
    start = F.lit(f"{first_day} 00:00:00").cast("timestamp_ntz")
    after = F.date_add(F.lit(last_day).cast("date"), 1).cast("timestamp_ntz")
    return fact.filter((F.col("InvoiceDate") < start) | (F.col("InvoiceDate") >= after))


def cancellation_prefix_mismatch(fact: DataFrame) -> DataFrame:
    """Lines whose invoice prefix and cancellation flag disagree, in either direction."""
    return fact.filter(F.upper("InvoiceNo").startswith("C") != F.col("IsCancellation"))


def anomaly_report(fact: DataFrame) -> DataFrame:
    """Six named counts, one row each.

    Duplicate row ids need one grouping by id; the other counts ride along on it as sums,
    so the fact is read once.
    """
    blank = lambda name: F.coalesce(F.trim(name) == "", F.lit(True))
    missing = (
        blank("InvoiceNo") | blank("StockCode") | blank("Country")
        | F.col("Quantity").isNull() | F.col("InvoiceDate").isNull() | F.col("UnitPrice").isNull()
    )
    disagrees = F.upper("InvoiceNo").startswith("C") != F.col("IsCancellation")
    by_id = fact.groupBy("SourceRowId").agg(
        F.count("*").alias("row_count"), F.count_if(missing).alias("missing"),
        F.count_if("ZeroPrice").alias("zero_price"), F.count_if("UnknownCustomer").alias("unknown_customer"),
        F.count_if(disagrees).alias("mismatch"),
    )
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint")
    return by_id.agg(
        total("row_count").alias("source_row_count"),
        F.count_if(F.col("row_count") > 1).alias("duplicate_source_row_id"),
        total("missing").alias("required_field_missing"),
        total("zero_price").alias("zero_price_line"),
        total("unknown_customer").alias("unknown_customer_line"),
        total("mismatch").alias("cancellation_prefix_mismatch"),
    ).unpivot(
        [], ["source_row_count", "duplicate_source_row_id", "required_field_missing", "zero_price_line",
             "unknown_customer_line", "cancellation_prefix_mismatch"],
        "check_name", "observed_value",
    )
