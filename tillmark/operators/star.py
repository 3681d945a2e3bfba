"""Standardised fact, modelled fact and the dimensions derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.months import year_month
from tillmark.functions.numbers import AMOUNT

UNKNOWN = "UNKNOWN"
# Parts of the member that all lines without a customer share.
UNKNOWN_SALTS = 64


def standardized_fact(raw: DataFrame, description: str = "Description") -> DataFrame:
    """Raw table to the fact: trimmed country and the line amount."""
    return raw.select(
        "SourceRowId", "InvoiceNo", "StockCode", F.col(description).alias("Description"), "Quantity",
        "InvoiceDate", "UnitPrice", "CustomerID", F.trim("Country").alias("Country"),
        "IsCancellation", "UnknownCustomer", "ZeroPrice",
        (F.col("Quantity") * F.col("UnitPrice")).cast(AMOUNT).alias("LineAmount"),
    )


def model_fact(fact: DataFrame) -> DataFrame:
    """Fact with the two keys the star joins on."""
    return fact.withColumns({
        "InvoiceDateDate": F.to_date("InvoiceDate"),
        "CustomerKey": F.coalesce("CustomerID", F.lit(UNKNOWN)),
    })


def dim_date(fact: DataFrame) -> DataFrame:
    """The dates that occur, with English month names."""
    days = fact.select(F.to_date("InvoiceDate").alias("Date")).distinct()
    return days.select(
        "Date", F.year("Date").alias("Year"), F.month("Date").alias("MonthNumber"),
        F.date_format("Date", "MMMM").alias("MonthName"), year_month(F.col("Date")).alias("YearMonth"),
    )


def dim_product(fact: DataFrame, ignore_case: bool = False) -> DataFrame:
    """One row per stock code with its greatest description.

    ``ignore_case`` compares codes and descriptions as a case-insensitive database would.
    """
    if not ignore_case:
        return fact.groupBy("StockCode").agg(F.max("Description").alias("Description"))
    fold = lambda name: F.collate(F.col(name), "UTF8_LCASE")
    return (
        fact.groupBy(fold("StockCode").alias("code"))
        .agg(F.min("StockCode").alias("StockCode"), F.max(fold("Description")).alias("Description"))
        .select("StockCode", F.collate("Description", "UTF8_BINARY").alias("Description"))
    )


def dim_customer(fact: DataFrame) -> DataFrame:
    """One row per customer; lines without a customer share one member."""
    return fact.groupBy(F.coalesce("CustomerID", F.lit(UNKNOWN)).alias("CustomerKey")).agg(
        F.max("CustomerID").alias("CustomerID"), F.max("UnknownCustomer").alias("IsUnknownCustomer")
    )


def dim_country(fact: DataFrame) -> DataFrame:
    return fact.select("Country").distinct()


def star_denormalize(
    fact: DataFrame, dates: DataFrame, products: DataFrame, customers: DataFrame, countries: DataFrame,
) -> DataFrame:
    """Fact joined to its four dimensions; a line without a member keeps NULLs.

    The join strategy is left to Spark: sides within the broadcast threshold are broadcast,
    larger ones shuffle. Customers and products, which may be large, come first, and customers
    before products: so the shuffles carry neither descriptions nor what a date brings along.
    Lines without a customer share one member, so its key is dealt
    over ``UNKNOWN_SALTS`` parts, which Spark's skew rule would not do above an aggregate.
    """
    lines = model_fact(fact)
    is_unknown = F.col("CustomerKey") == UNKNOWN
    salt = F.when(is_unknown, F.pmod(F.xxhash64("InvoiceNo", "StockCode", "InvoiceDate"), F.lit(UNKNOWN_SALTS))).otherwise(0)
    parts = F.when(is_unknown, F.sequence(F.lit(0), F.lit(UNKNOWN_SALTS - 1))).otherwise(F.array(F.lit(0)))
    members = customers.select("CustomerKey", "IsUnknownCustomer", F.explode(parts.cast("array<bigint>")).alias("__salt"))
    # As a struct, so that what a date brings along may have names that the lines have too.
    day = F.struct(F.lit(True).alias("Date"), *[F.col(f"`{name}`") for name in dates.columns if name != "Date"])
    days = dates.select(F.col("Date").alias("InvoiceDateDate"), day.alias("__day"))
    keys = ["Country", "CustomerKey", "StockCode", "InvoiceDateDate"]
    return (
        lines.withColumn("__salt", salt.cast("bigint"))
        .join(members, ["CustomerKey", "__salt"], "left")
        .join(products.select("StockCode", F.col("Description").alias("ProductDescription")), "StockCode", "left")
        .join(days, "InvoiceDateDate", "left")
        .join(countries.select("Country", F.lit(True).alias("CountryKnown")), "Country", "left")
        .select(*keys, *[F.col(f"`{name}`") for name in lines.columns if name not in keys], *[F.col(f"__day.`{name}`") for name in dates.columns if name != "Date"],
                "ProductDescription", "IsUnknownCustomer", "CountryKnown")
    )


# Fact column, dimension and dimension key of each many-to-one relationship.
RELATIONSHIPS = (
    ("InvoiceDateDate", "DimDate", "Date"),
    ("StockCode", "DimProduct", "StockCode"),
    ("CustomerKey", "DimCustomer", "CustomerKey"),
    ("Country", "DimCountry", "Country"),
)


def _keys(columns: list[tuple[str, str]]):
    """(relationship, key) rows, one per relationship, from one scan."""
    return F.inline(F.array(*[
        F.struct(F.lit(name).alias("relationship"), F.col(column).cast("string").alias("key"))
        for name, column in columns
    ]))


def referential_integrity(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Lines and distinct keys without a dimension row, per relationship that has any.

    Keys are counted before the anti join, so a hot key joins as one row.
    """
    used = model_fact(fact).select(_keys([(dim, column) for column, dim, _ in RELATIONSHIPS]))
    counted = used.groupBy("relationship", "key").agg(F.count("*").alias("line_count"))
    known = None
    for _, dim, key in RELATIONSHIPS:
        one = dimensions[dim].select(F.lit(dim).alias("relationship"), F.col(key).cast("string").alias("key"))
        known = one if known is None else known.unionByName(one)
    return counted.join(known, ["relationship", "key"], "left_anti").groupBy("relationship").agg(
        F.count("*").alias("orphan_keys"), F.sum("line_count").alias("orphan_lines")
    )


def key_uniqueness(dimensions: dict[str, DataFrame]) -> DataFrame:
    """Keys that are NULL or held by more than one dimension row, per dimension that has any."""
    keys = None
    for _, dim, key in RELATIONSHIPS:
        one = dimensions[dim].select(F.lit(dim).alias("dimension"), F.col(key).cast("string").alias("key"))
        keys = one if keys is None else keys.unionByName(one)
    counted = keys.groupBy("dimension", "key").agg(F.count("*").alias("copies"))
    bad = counted.filter((F.col("copies") > 1) | F.col("key").isNull())
    return bad.groupBy("dimension").agg(
        F.count_if(F.col("key").isNotNull()).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("copies"))), F.lit(0)).alias("null_keys"),
    )
