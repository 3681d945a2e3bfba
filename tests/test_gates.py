"""Gates, duplicates and plans that the fixture tables alone do not reach."""

from decimal import Decimal

import oracle

from tillmark.operators import measures, quality, reconcile
from tillmark.sources.fixtures import sales_line

SLICES = "slice_id string, slice_value string, metric_id string, status string"


def codes(spark, rows):
    results = spark.createDataFrame(rows, SLICES)
    return sorted((r.code, r.slice_id, r.metric_id) for r in reconcile.reconciliation_gate(results, ["net_sales"]).collect())


def test_gate_is_open_only_when_everything_passed(spark):
    assert codes(spark, [("all", None, "net_sales", "passed"), ("all", None, "other", "both-null")]) == []


def test_gate_is_closed_without_slices(spark):
    assert codes(spark, []) == [("baseline_reconciliation_failed", None, None), ("baseline_slices_missing", None, None)]


def test_gate_sees_a_failed_metric_outside_the_list(spark):
    rows = [("all", None, "net_sales", "passed"), ("all", None, "other", "failed")]
    assert codes(spark, rows) == [("baseline_reconciliation_failed", None, None), ("baseline_slice_failed", "all", None)]


def test_gate_names_a_missing_metric(spark):
    assert codes(spark, [("all", None, "other", "passed")]) == [("baseline_metric_failed", "all", "net_sales")]


def test_a_group_without_orders_keeps_its_row(spark):
    fact = spark.createDataFrame(
        [("A", "1", 2, Decimal("5.00"), Decimal("10.00"), False), ("B", "C2", -1, Decimal("5.00"), Decimal("-5.00"), True)],
        "Country string, InvoiceNo string, Quantity long, UnitPrice decimal(18,2), LineAmount decimal(18,2), IsCancellation boolean",
    )
    found = {r.Country: r.average_order_value for r in measures.average_order_value(fact, ["Country"]).collect()}
    assert found == {"A": 10.0, "B": None}


def test_rows_with_an_equal_locator_are_duplicates_too(spark):
    table = spark.createDataFrame([("k", "7"), ("k", "7"), ("k", "9"), ("m", "1")], "id string, line string")
    contract = {"dataset": {"primary_key": ["id"]}, "columns": [{"name": "id", "type": "string"}], "expectations": {}}
    found = quality.key_issues(table, contract, "line").collect()
    assert sorted((r.code, r.row) for r in found) == [("duplicate_primary_key", "7"), ("duplicate_primary_key", "9")]


def scans(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("lineitem.parquet")


def test_measures_read_the_lines_once(spark, sf_dir):
    fact = sales_line(spark, sf_dir)
    once = scans(fact)
    assert once > 0
    for frame in (measures.measures_by(fact), measures.measures_by(fact, ["Country"]), measures.measures_all_slices(fact)):
        assert scans(frame) == once


def test_no_lines_give_the_overall_slice_alone(spark, sf_dir):
    nothing = sales_line(spark, sf_dir).limit(0)
    rows = measures.measures_all_slices(nothing).collect()
    assert [(r.slice_id, r.net_sales, r.order_count) for r in rows] == [("all", 0, 0)]
    assert oracle.plan(measures.measures_by(nothing)).count("Union") == oracle.plan(nothing).count("Union")


def test_lines_without_a_customer_are_dealt_over_parts(spark, sf_dir):
    from tillmark.operators import star

    fact = sales_line(spark, sf_dir)
    dimensions = star.dim_date(fact), star.dim_product(fact), star.dim_customer(fact), star.dim_country(fact)
    joined = star.star_denormalize(fact, *dimensions)
    assert "__salt" not in joined.columns
    assert joined.count() == fact.count()
    unknown = joined.where(f"CustomerKey = '{star.UNKNOWN}'")
    assert unknown.count() > 0 and unknown.where("IsUnknownCustomer IS NULL").count() == 0


def test_star_joins_large_dimensions_first_and_keeps_its_columns(spark, sf_dir):
    from tillmark.operators import star

    fact = sales_line(spark, sf_dir)
    joined = star.star_denormalize(fact, star.dim_date(fact), star.dim_product(fact), star.dim_customer(fact), star.dim_country(fact))
    keys = ["Country", "CustomerKey", "StockCode", "InvoiceDateDate"]
    rest = [name for name in star.model_fact(fact).columns if name not in keys]
    assert joined.columns == [*keys, *rest, "Year", "MonthNumber", "MonthName", "YearMonth", "ProductDescription", "IsUnknownCustomer", "CountryKnown"]
    steps = [line for line in joined._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
    named = [next(key for key in ("Country#", "InvoiceDateDate#", "CustomerKey#", "StockCode#") if key in line) for line in steps]
    # The outermost join comes first in the text.
    assert named == ["Country#", "InvoiceDateDate#", "StockCode#", "CustomerKey#"]


def test_star_query_derives_the_lines_once(spark, sf_dir):
    from tillmark.plans.catalog import QUERIES

    assert "lineitem" not in oracle.plan(QUERIES["star_denormalize"](spark, sf_dir))


def test_customers_meet_orders_before_lines(spark, sf_dir):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = oracle.plan(sales_line(spark, sf_dir)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    sides = [below for line, below in zip(lines, lines[1:]) if "hashpartitioning(o_custkey" in line or "hashpartitioning(c_nationkey" in line]
    assert len(sides) == 2 and not any("l_orderkey" in side for side in sides)


def test_slices_copy_no_member(spark, sf_dir):
    expands = [line for line in oracle.plan(measures.measures_all_slices(sales_line(spark, sf_dir))).splitlines() if "Expand" in line]
    assert expands and not any("member" in line for line in expands)


def test_members_count_once_in_each_slice(spark, sf_dir):
    from pyspark.sql import functions as F

    # Invoices and customers in several countries and months, numbers with blanks, nulls.
    lines = sales_line(spark, sf_dir).where("pmod(hash(SourceRowId), 12) = 5").withColumns({
        "InvoiceNo": F.expr("CASE pmod(hash(SourceRowId), 9) WHEN 0 THEN NULL WHEN 1 THEN ' 7' WHEN 2 THEN '7' ELSE substr(InvoiceNo, 1, 2) END"),
        "CustomerID": F.expr("substr(CustomerID, 1, 1)"),
        "Country": F.expr("CASE WHEN Country <> 'NATION_3' THEN substr(Country, 1, 8) END"),
    })
    counts = ["order_count", "active_customers", "cancelled_invoice_count", "all_invoice_count", "net_sales", "units_sold"]
    slices = measures.measures_all_slices(lines)
    for name, keys in {"all": [], "country": ["Country"], "month": ["Month"]}.items():
        own = lines.withColumn("Month", F.date_format("InvoiceDate", "yyyy-MM"))
        wanted = measures.measures_by(own, keys).select(*(keys or [F.lit(None)]), *counts)
        assert sorted(map(str, wanted.collect()), key=str) == sorted(
            map(str, slices.where(F.col("slice_id") == name).select(F.col("slice_value").alias((keys or ["NULL"])[0]), *counts).collect()))


def test_larger_sources_are_written_as_more_files(spark, sf_dir, monkeypatch):
    import glob

    from tillmark.plans import catalog
    from tillmark.sources.fixtures import contract_text

    table = contract_text(spark, sf_dir).select("LineRef", "StockCode")
    few = catalog._stored_text(table, "few", 3)
    monkeypatch.setattr(catalog, "FILE_BYTES", 20_000)
    many = catalog._stored_text(table, "many", 3)
    assert len(glob.glob(f"{few}/*.csv")) == 3 < 6 <= len(glob.glob(f"{many}/*.csv"))
    read = [catalog.delimited.scan_contract_csv(spark, path, row="row").orderBy("row").collect() for path in (few, many)]
    assert read[0] == read[1]
