from datetime import datetime
from decimal import Decimal

import pytest
from oracle import plan
from pyspark.sql import functions as F

from tillmark.functions.months import month_bounds
from tillmark.functions.numbers import decimal_text
from tillmark.operators import measures, reconcile, report, security, star
from tillmark.plans.model import refresh_model
from tillmark.sources import delimited, fixtures, sinks

LONG = "slice_id string, slice_value string, metric_id string, value double"


def sets(spark):
    left = spark.createDataFrame([("all", None, "gross_sales", 10.0), ("all", None, "cancellation_rate", 0.1),
                                  ("all", None, "sales_mom_pct", None)], LONG)
    right = spark.createDataFrame([("all", None, "gross_sales", 10.005), ("all", None, "cancellation_rate", 0.10005),
                                   ("all", None, "sales_mom_pct", None)], LONG)
    return left, right


def test_tolerances_and_both_null(spark):
    results = reconcile.reconcile_metrics(*sets(spark))
    assert {r.metric_id: r.status for r in results.collect()} == {
        "gross_sales": "passed", "cancellation_rate": "passed", "sales_mom_pct": "both-null"}
    assert reconcile.reconciliation_status(results).first().status == "passed"
    assert reconcile.reconciliation_gate(results, ["gross_sales", "sales_mom_pct"]).isEmpty()
    assert [r.metric_id for r in reconcile.reconciliation_gate(results, ["net_sales"]).collect()] == ["net_sales"]


def test_tolerance_is_inclusive_and_missing_fails(spark):
    left = spark.createDataFrame([("a", "x", "net_sales", 1.0), ("a", "x", "units_sold", 1.0), ("a", "x", "order_count", 1.0)], LONG)
    right = spark.createDataFrame([("a", "x", "net_sales", 1.01), ("a", "x", "units_sold", 1.0101)], LONG)
    statuses = {r.metric_id: r.status for r in reconcile.reconcile_metrics(left, right).collect()}
    assert statuses == {"net_sales": "passed", "units_sold": "failed", "order_count": "null-mismatch"}
    assert {r.status for r in reconcile.reconcile_slices(reconcile.reconcile_metrics(left, right)).collect()} == {"failed"}
    assert reconcile.reconciliation_status(reconcile.reconcile_metrics(left.limit(0), right.limit(0))).first().status == "failed"


@pytest.mark.parametrize("number, text", [("2.55", "2.55"), ("15.3000", "15.30"), ("7.0000", "7.00"), ("0.0000", "0.00"),
                                          ("-0.0450", "-0.045"), ("123456789012.3456", "123456789012.3456")])
def test_decimal_text(spark, number, text):
    frame = spark.range(1).select(decimal_text(F.lit(Decimal(number)).cast("decimal(20,4)")).alias("t"))
    assert frame.first().t == text


def test_export_row(spark):
    row = spark.createDataFrame([("2009-2010:2", "536365", "85123A", None, 6, datetime(2009, 12, 1, 8, 26), Decimal("2.55"), None,
                                  "United Kingdom", False, True, False, Decimal("15.30"))],
                                "SourceRowId string, InvoiceNo string, StockCode string, Description string, Quantity bigint, InvoiceDate timestamp_ntz, "
                                "UnitPrice decimal(18,4), CustomerID string, Country string, IsCancellation boolean, UnknownCustomer boolean, "
                                "ZeroPrice boolean, LineAmount decimal(20,4)")
    out = delimited.export_rows(row).first()
    assert (out.InvoiceDate, out.UnitPrice, out.LineAmount) == ("2009-12-01T08:26:00", "2.55", "15.30")
    assert (out.Description, out.CustomerID, out.IsCancellation, out.UnknownCustomer) == ("", "", "false", "true")


def test_missing_file_and_long_delimiter(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="data_file_not_found"):
        delimited.scan_contract_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="invalid_delimiter"):
        delimited.scan_contract_csv(spark, str(tmp_path), delimiter="||")


def test_row_numbers_run_on_across_files(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(1000).select(F.col("id").cast("string").alias("id")).repartition(7).write.option("header", True).csv(path)
    numbered = delimited.scan_contract_csv(spark, path, row="row")
    assert sorted(r.row for r in numbered.collect()) == list(range(2, 1002))


def test_fingerprint_sees_repeats_and_cell_borders(spark):
    make = lambda *rows: tuple(delimited.extract_fingerprint(spark.createDataFrame(rows, "a string, b string")).first())
    assert make(("x", "y"), ("p", "q")) == make(("p", "q"), ("x", "y"))
    assert make(("x", "y")) != make(("x", "y"), ("x", "y"), ("x", "y"))
    assert make(("xy", "z")) != make(("x", "yz"))


def test_guarded_write_accepts_an_empty_table(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(3)
    sinks.guarded_table_write(rows.limit(0), path)
    sinks.guarded_table_write(rows, path)
    with pytest.raises(ValueError, match="raw_table_not_empty_use_replace"):
        sinks.guarded_table_write(rows, path)


def test_month_bounds():
    assert [d.isoformat() for d in month_bounds("2010-01", -1)] == ["2009-12-01", "2010-01-01"]
    assert [d.isoformat() for d in month_bounds("2010-12")] == ["2010-12-01", "2011-01-01"]
    with pytest.raises(ValueError):
        month_bounds("2010-13")


def test_case_insensitive_products(spark):
    lines = spark.createDataFrame([("85123a", "lamp"), ("85123A", "LAMP b"), ("x", None)], "StockCode string, Description string")
    assert star.dim_product(lines).count() == 3
    folded = {r.StockCode: r.Description for r in star.dim_product(lines, ignore_case=True).collect()}
    assert folded == {"85123A": "LAMP b", "x": None}


def test_grant_listed_twice_does_not_multiply_lines(spark, sf_dir):
    fact, bridge = fixtures.sales_line(spark, sf_dir), fixtures.security_bridge(spark)
    once = security.rls_fact(fact, bridge, "manager.a@example.invalid").count()
    assert once > 0 and once == security.rls_fact(fact, bridge.union(bridge), "manager.a@example.invalid").count()
    assert security.rls_fact(fact, bridge, "former.c@example.invalid").isEmpty()
    assert security.rls_fact(fact, bridge, "nobody@example.invalid").isEmpty()


def test_stored_model_answers_like_the_source_and_prunes_months(spark, sf_dir, tmp_path):
    fact = fixtures.sales_line(spark, sf_dir)
    model = refresh_model(fact, str(tmp_path / "model"))
    assert measures.measures_by(model.fact).collect() == measures.measures_by(fact).collect()
    month = measures.measures_for_month(model.fact, "1996-11")
    assert month.collect() == measures.measures_for_month(fact, "1996-11").collect()
    assert "PartitionFilters: [isnotnull(YearMonth" in plan(month) or "PartitionFilters: [YearMonth" in plan(month)
    joined = star.star_denormalize(model.fact.drop("InvoiceDateDate", "CustomerKey", "YearMonth"), model.dates, model.products,
                                   model.customers, model.countries)
    assert joined.count() == fact.count() and joined.filter("Year IS NULL OR CountryKnown IS NULL").isEmpty()


def test_month_filter_reaches_the_scan(spark, sf_dir):
    text = plan(report.slicer_filter(fixtures.sales_line(spark, sf_dir), {"YearMonth": ["1996-11"], "Country": ["NATION_2"]}))
    assert "GreaterThanOrEqual(o_orderdate" in text and "EqualTo(n_name,NATION_2)" in text
