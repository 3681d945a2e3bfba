from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmark.operators import measures as M
from tillmark.operators import periods, report

SCHEMA = ("SourceRowId string, InvoiceNo string, StockCode string, Description string, Quantity bigint, "
          "InvoiceDate timestamp_ntz, UnitPrice decimal(20,4), CustomerID string, Country string, "
          "IsCancellation boolean, UnknownCustomer boolean, ZeroPrice boolean, LineAmount decimal(20,4)")


def fact(spark, *rows):
    from datetime import datetime

    base = dict(SourceRowId="1", InvoiceNo="A-001", StockCode="P-001", Description="Product", Quantity=2,
                InvoiceDate="2010-11-15T09:00:00", UnitPrice="5.00", CustomerID="C-001", Country="United Kingdom",
                IsCancellation=False, UnknownCustomer=False, ZeroPrice=False, LineAmount="10.00")
    data = []
    for changes in rows:
        row = {**base, **changes}
        row["InvoiceDate"] = datetime.fromisoformat(row["InvoiceDate"])
        row["UnitPrice"], row["LineAmount"] = Decimal(row["UnitPrice"]), Decimal(row["LineAmount"])
        data.append(tuple(row.values()))
    return spark.createDataFrame(data, SCHEMA)


def test_cancellation_leaves_completed_measures_but_stays_in_net(spark):
    lines = fact(spark, {}, dict(InvoiceNo="C-001", Quantity=-2, IsCancellation=True, LineAmount="-10.00"))
    row = M.measures_by(lines).first()
    assert (row.gross_sales, row.cancelled_sales, row.net_sales) == (10, 10, 0)
    assert (row.order_count, row.units_sold, row.cancelled_invoice_count, row.all_invoice_count) == (1, 2, 1, 2)
    assert (row.average_order_value, row.cancellation_rate) == (10.0, 0.5)


def test_blank_customer_is_not_active_and_no_prior_month_is_null(spark):
    lines = fact(spark, dict(CustomerID=""), dict(InvoiceNo="A-002", CustomerID="C-002"), dict(InvoiceNo="A-3", CustomerID=None))
    row = M.measures_for_month(lines, "2010-11").first()
    assert (row.active_customers, row.sales_mom_pct, row.sales_yoy_pct) == (1, None, None)


def test_no_lines_give_zero_sums_and_null_ratios(spark):
    row = M.measures_by(fact(spark, {}).limit(0)).first()
    assert (row.gross_sales, row.order_count, row.all_invoice_count) == (0, 0, 0)
    assert (row.average_order_value, row.cancellation_rate) == (None, None)


def test_spellings_of_invoice_and_customer(spark):
    lines = fact(spark, dict(InvoiceNo="A"), dict(InvoiceNo=" A"), dict(InvoiceNo=" B "), dict(InvoiceNo=""),
                 dict(InvoiceNo=None), dict(InvoiceNo="A", CustomerID=" C-001"))
    row = M.measures_by(lines).first()
    plain = lines.agg(
        F.count_distinct("InvoiceNo").alias("o"), F.count_distinct(F.nullif(F.trim("InvoiceNo"), F.lit(""))).alias("a"),
        F.count_distinct("CustomerID").alias("c")).first()
    assert (row.order_count, row.all_invoice_count, row.active_customers) == (plain.o, plain.a, plain.c) == (4, 2, 2)


def test_month_without_lines_falls_by_all_against_a_month_with_lines(spark):
    row = M.measures_for_month(fact(spark, dict(InvoiceDate="2010-10-31T23:59:59")), "2010-11").first()
    assert (row.net_sales, row.sales_mom_pct) == (0, -1.0)


def test_null_country_is_a_group_of_its_own_in_slices(spark):
    lines = fact(spark, {}, dict(Country=None, InvoiceNo="B"), dict(InvoiceDate="2010-12-01T00:00:00", InvoiceNo="C"))
    rows = {(r.slice_id, r.slice_value): r for r in M.measures_all_slices(lines).collect()}
    assert rows[("all", None)].order_count == 3
    assert rows[("country", None)].net_sales == 10
    assert rows[("month", "2010-12")].sales_mom_pct == -0.5


def test_changes_cross_the_year_and_skip_gaps(spark):
    lines = fact(spark, dict(InvoiceDate="2009-12-31T00:00:00", LineAmount="50"), dict(InvoiceDate="2010-01-01T00:00:00", LineAmount="75"),
                 dict(InvoiceDate="2010-12-05T00:00:00", LineAmount="100"))
    rows = {r.YearMonth: r for r in periods.monthly_changes(lines).collect()}
    assert rows["2010-01"].sales_mom_pct == 0.5
    assert (rows["2010-12"].sales_mom_pct, rows["2010-12"].sales_yoy_pct) == (None, 1.0)


def test_page_rejects_a_slicer_it_does_not_have(spark):
    with pytest.raises(ValueError, match="slicer_not_on_page"):
        report.page_cards(fact(spark, {}), "Executive Overview", {"StockCode": ["P"]})


def test_a_third_of_all_lines_on_one_invoice_customer_and_country(spark):
    n = 30_000
    hot = F.col("id") % 3 == 0
    lines = spark.range(n).select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("I"), F.col("id") % 997)).alias("InvoiceNo"),
        F.when(hot, "H").otherwise((F.col("id") % 101).cast("string")).alias("CustomerID"),
        F.when(hot, "X").otherwise(F.concat(F.lit("N"), F.col("id") % 7)).alias("Country"),
        F.lit(1).cast("bigint").alias("Quantity"), F.lit(2).cast("decimal(20,4)").alias("UnitPrice"),
        F.lit(False).alias("IsCancellation"), F.lit(2).cast("decimal(20,4)").alias("LineAmount"),
        F.lit("2020-01-05").cast("timestamp_ntz").alias("InvoiceDate"),
    )
    row = M.measures_by(lines).first()
    assert (row.order_count, row.active_customers, row.net_sales) == (998, 102, 2 * n)
    slices = {(r.slice_id, r.slice_value): r for r in M.measures_all_slices(lines).collect()}
    assert slices[("country", "X")].order_count == 1 and slices[("month", "2020-01")].order_count == 998
