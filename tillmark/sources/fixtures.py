"""Sales tables derived from the driver's order tables by declared rules.

Every row of ``lineitem`` becomes one row. A row's identity is the text of its own
columns, not a row number, so no window or sort is needed and a hot order cannot
pile up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.numbers import AMOUNT, PRICE

LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order, customer nation and part.

    Customers join the orders, of which there are fewer than lines, so that lines are shuffled
    twice, last by order: an order's lines come out of one task.
    """
    orders = (
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        .join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
              F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
              F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return (
        table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
        .join(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice"),
              F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )


def line_ref() -> Column:
    """Unique text id of a line, made of its own columns."""
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int"), F.date_format("l_shipdate", "yyyyMMdd"),
    )


def _every(column: str, modulus: int) -> Column:
    return F.col(column) % modulus == 0


def sales_line(spark: SparkSession, sf_dir: str, mixed_signs: bool = False) -> DataFrame:
    """Standardised fact rows; ``mixed_signs`` leaves some cancelled quantities positive."""
    returned = F.col("l_returnflag") == "R"
    negated = returned & ~_every("l_partkey", 89) if mixed_signs else returned
    quantity = F.when(negated, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int")
    price = F.when(_every("l_partkey", 97), F.lit(0).cast(PRICE)).otherwise(F.col("p_retailprice").cast(PRICE))
    return order_lines(spark, sf_dir).select(
        line_ref().alias("SourceRowId"),
        F.concat(F.when(returned, "C").otherwise(""), F.col("l_orderkey").cast("string")).alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        quantity.alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        price.alias("UnitPrice"),
        F.when(~_every("o_custkey", 5), F.col("o_custkey").cast("string")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
        returned.alias("IsCancellation"),
        _every("o_custkey", 5).alias("UnknownCustomer"),
        _every("l_partkey", 97).alias("ZeroPrice"),
        (quantity * price).cast(AMOUNT).alias("LineAmount"),
    )


def gap_month_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact without May 1996, so that a naive previous-row comparison goes wrong."""
    moment = F.col("InvoiceDate")
    first, after = (F.lit(f"{day} 00:00:00").cast("timestamp_ntz") for day in ("1996-05-01", "1996-06-01"))
    return sales_line(spark, sf_dir).filter((moment < first) | (moment >= after))


def raw_sales_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet rows as recorded, all text but the date, with defects by modulus rules."""
    key, part, customer = F.col("l_orderkey"), F.col("l_partkey"), F.col("o_custkey")
    returned = F.col("l_returnflag") == "R"
    prefix = F.when(returned, F.when(key % 2 == 0, "C").otherwise("c")).otherwise("")
    signed = F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int")
    return order_lines(spark, sf_dir).select(
        line_ref().alias("SourceRowId"),
        F.when(key % 1009 == 0, "").otherwise(F.concat(prefix, key.cast("string"))).alias("Invoice"),
        F.concat(F.lit(" "), part.cast("string")).alias("StockCode"),
        F.when(part % 50 == 0, "  ").otherwise(F.col("p_name")).alias("Description"),
        F.when(key % 503 == 0, "two").when(key % 499 == 0, "1.5").when(key % 491 == 0, F.lit(None))
        .otherwise(F.concat(signed.cast("string"), F.lit(".0"))).alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.when(part % 193 == 0, "-1").when(part % 191 == 0, "n/a").when(part % 97 == 0, "0")
        .when(part % 89 == 0, "2.345").when(part % 83 == 0, "2.355").when(part % 79 == 0, "0.004")
        .otherwise(F.col("p_retailprice").cast("decimal(18,2)").cast("string")).alias("Price"),
        F.when(customer % 5 == 0, F.lit(None)).when(customer % 7 == 0, F.concat(F.lit("A-"), customer.cast("string")))
        .otherwise(F.concat(customer.cast("string"), F.lit(".0"))).alias("Customer ID"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("Country"),
    )


def raw_sales_sheets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw rows as two sheets that spell their headers differently."""
    raw = raw_sales_line(spark, sf_dir)
    split = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    early = raw.filter(F.col("InvoiceDate") < split)
    late = raw.filter(F.col("InvoiceDate") >= split).withColumnsRenamed(
        {"Invoice": "InvoiceNo", "Price": "UnitPrice", "Customer ID": "CustomerID"}
    )
    return {"Before 1998": early, "From 1998": late}


def raw_sales_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows whose date is text in several spellings, some unreadable."""
    key, moment = F.col("l_orderkey"), F.col("o_orderdate")
    text = (
        F.when(key % 479 == 0, "not-a-date").when(key % 467 == 0, "").when(key % 463 == 0, F.lit(None))
        .when(key % 3 == 0, F.date_format(moment, "yyyy-MM-dd"))
        .when(key % 3 == 1, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
    )
    return order_lines(spark, sf_dir).select(line_ref().alias("SourceRowId"), text.alias("InvoiceDate"))


def contract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as contract text with one kind of defect per modulus, plus ``LineRef``."""
    key, part, customer = F.col("l_orderkey"), F.col("l_partkey"), F.col("o_custkey")
    returned = F.col("l_returnflag") == "R"
    whole = F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int")
    quantity = F.when(part % 167 == 0, F.lit(0)).otherwise(whole)
    price = F.when(part % 97 == 0, F.lit(0).cast(PRICE)).otherwise(F.col("p_retailprice").cast(PRICE))
    amount = (quantity * price).cast(AMOUNT) + F.when(part % 173 == 0, F.lit(1)).otherwise(F.lit(0))
    yes_no = lambda test: F.when(test, "true").otherwise("false")
    return order_lines(spark, sf_dir).select(
        line_ref().alias("LineRef"),
        F.when(part % 251 == 0, " ").when(part % 61 == 0, F.concat(F.lit("D"), key.cast("string")))
        .otherwise(line_ref()).alias("SourceRowId"),
        F.when(key % 1009 == 0, "").otherwise(
            F.concat(F.when(returned, "C").otherwise(""), key.cast("string"))).alias("InvoiceNo"),
        part.cast("string").alias("StockCode"),
        F.when(part % 50 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("Description"),
        F.when(key % 503 == 0, "two").when(key % 499 == 0, "1.5").when(key % 491 == 0, F.lit(None))
        .when(key % 487 == 0, F.concat(F.lit("0"), F.abs(quantity).cast("string")))
        .otherwise(quantity.cast("string")).alias("Quantity"),
        F.when(key % 479 == 0, "not-a-date").otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("InvoiceDate"),
        F.when(part % 193 == 0, "-1.00").when(part % 191 == 0, "n/a").otherwise(
            price.cast("string")).alias("UnitPrice"),
        F.when(customer % 5 != 0, customer.cast("string")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
        F.when(part % 181 == 0, "maybe").otherwise(yes_no(returned)).alias("IsCancellation"),
        yes_no(customer % 5 == 0).alias("UnknownCustomer"),
        yes_no(part % 97 == 0).alias("ZeroPrice"),
        amount.cast("string").alias("LineAmount"),
    )


def long_number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract text whose numbers pass the width of a decimal or double, with defects by modulus rules."""
    key, part = F.col("l_orderkey"), F.col("l_partkey")
    negative = F.when(key % 2 == 0, "-").otherwise("")
    serial = F.concat(negative, F.lit("1"), F.lpad(key.cast("string"), 7, "0"), F.lpad(part.cast("string"), 32, "0"))
    units = (F.lit(10_000_000_000_000).cast("decimal(20,0)") + part).cast("decimal(20,0)")
    rate = (F.col("l_linenumber").cast("decimal(10,7)") + F.lit("0.1234567").cast("decimal(10,7)")).cast("decimal(10,7)")
    off = F.when(key % 17 == 0, "0.0000003").when(key % 17 == 1, "0.0000002").otherwise("0").cast("decimal(10,7)")
    return order_lines(spark, sf_dir).select(
        line_ref().alias("LineRef"), serial.alias("Serial"),
        F.concat(F.lit("0.50000000000000000000000000000000000"), F.lpad((part % 30).cast("string"), 2, "0"), F.repeat(F.lit("0"), (key % 5).cast("int"))).alias("Share"),
        units.cast("string").alias("Units"), rate.cast("string").alias("Rate"), (units * rate + off).cast("decimal(38,7)").cast("string").alias("Amount"),
    )


def security_bridge(spark: SparkSession) -> DataFrame:
    """User-to-country grants for the simulated roles."""
    return spark.sql("""
        SELECT * FROM VALUES
          ('manager.a@example.invalid', 'NATION_2', true), ('manager.b@example.invalid', 'NATION_7', true),
          ('manager.b@example.invalid', 'NATION_11', true), ('former.c@example.invalid', 'NATION_3', false)
        AS grants(UserPrincipalName, Country, IsActive)
    """)


def security_users(spark: SparkSession) -> DataFrame:
    """The users above and one without any grant."""
    return spark.sql("""
        SELECT * FROM VALUES ('manager.a@example.invalid'), ('manager.b@example.invalid'),
          ('former.c@example.invalid'), ('unmapped.d@example.invalid')
        AS users(UserPrincipalName)
    """)
