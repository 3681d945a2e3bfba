"""Registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as types_

from tillmark.functions import exact
from tillmark.functions import numbers as N
from tillmark.functions import text as T
from tillmark.functions.months import year_month
from tillmark.operators import (
    measures, metric_contract, normalise, periods, profile, quality, reconcile, report, security, star,
)
from tillmark.plans.contracts import SALES_CONTRACT
from tillmark.sources import delimited, sinks
from tillmark.sources import fixtures as fx
from tillmark.sources.scratch import release, scratch_path, source_bytes, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(result: DataFrame) -> DataFrame:
    """Types two engines hand out alike: decimals as double, dates as ISO text."""
    def plain(field: types_.StructField):
        if isinstance(field.dataType, types_.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, types_.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return result.select(*[plain(field) for field in result.schema.fields])


def query(build: Query) -> Query:
    """Register a query under its function's name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: comparable(build(spark, sf_dir))
    return build


# ---- contracts the queries use on the driver data -------------------------------

CHECKED_CONTRACT = {
    **SALES_CONTRACT,
    "expectations": {"max_rows": 5000},
    "columns": [
        {**column, **{
            "Country": {"allowed_values": [f"NATION_{n}" for n in range(24)]},
            "Quantity": {"min": -45, "max": 45},
            "UnitPrice": {"min": 0, "max": 905.5},
        }.get(column["name"], {})}
        for column in SALES_CONTRACT["columns"]
    ] + [{"name": "Channel", "type": "string", "required": True, "nullable": False}],
    "row_rules": SALES_CONTRACT["row_rules"] + [
        {"name": "price_from_amount", "type": "formula", "target": "UnitPrice",
         "expression": "LineAmount / Quantity", "tolerance": 0.001},
    ],
}

METRIC_CONTRACT = [
    {"id": "line_count", "aggregation": "distinct_count", "column": "SourceRowId", "expected": 59500, "tolerance": 500},
    {"id": "invoice_count", "aggregation": "distinct_count", "column": "InvoiceNo", "expected": 25000, "tolerance": 1},
    {"id": "net_sales", "aggregation": "sum", "column": "LineAmount", "expected": 475000000, "tolerance": 5000000},
    {"id": "average_line", "aggregation": "average", "column": "LineAmount", "expected": 1, "tolerance": 0.01},
    {"id": "average_quantity", "aggregation": "average", "column": "Quantity", "expected": 8, "tolerance": 1},
    {"id": "net_per_invoice", "aggregation": "ratio", "numerator_metric": "net_sales",
     "denominator_metric": "invoice_count", "expected": 19000, "tolerance": 1000},
    {"id": "invoice_value_share", "aggregation": "ratio", "numerator_metric": "net_per_invoice",
     "denominator_metric": "net_sales", "expected": 0.00004, "tolerance": 0.00001},
    {"id": "quantity_per_line", "aggregation": "ratio", "numerator_metric": "average_quantity",
     "denominator_metric": "line_count", "expected": 0, "tolerance": 1},
]

USER = "manager.b@example.invalid"


def _mapped_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise.map_source_columns(fx.raw_sales_line(spark, sf_dir), keep=["SourceRowId"])


def _normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise.normalise_lines(_mapped_raw(spark, sf_dir))


def _stored_csv(fact: DataFrame, name: str) -> DataFrame:
    path = scratch_path(fact.sparkSession, name)
    delimited.export_extract(fact, path)
    return delimited.scan_contract_csv(fact.sparkSession, path)


# ---- sources and sinks ----------------------------------------------------------

@query
def scan_contract_csv(spark, sf_dir):
    scanned = _stored_csv(fx.sales_line(spark, sf_dir), "scan")
    cells = [F.coalesce(F.length(name), F.lit(0)).cast("bigint") for name in scanned.columns]
    return scanned.agg(
        F.count("*").alias("row_count"), F.lit(len(scanned.columns)).cast("bigint").alias("column_count"),
        F.sum(sum(cells[1:], cells[0])).alias("text_length"),
    )


@query
def typed_fact_from_text(spark, sf_dir):
    return delimited.typed_fact_from_text(_stored_csv(fx.sales_line(spark, sf_dir), "typed"))


@query
def guarded_table_write(spark, sf_dir):
    fact = fx.sales_line(spark, sf_dir)
    kept, replaced = scratch_path(spark, "kept"), scratch_path(spark, "replaced")
    sinks.guarded_table_write(fact, kept)
    try:
        sinks.guarded_table_write(fact, kept)
        refused = "none"
    except ValueError as error:
        refused = str(error)
    sinks.guarded_table_write(fact.limit(0), replaced)
    sinks.guarded_table_write(fact, replaced)
    sinks.guarded_table_write(measures.cancelled_lines(fact), replaced, replace=True)
    count = lambda path, second: sinks.read_table(spark, path).agg(F.count("*").alias("row_count")).select(
        F.lit(second).alias("second_write"), "row_count")
    return count(kept, refused).unionByName(count(replaced, "replaced"))


@query
def ingest_with_rejects(spark, sf_dir):
    path = scratch_path(spark, "load")
    sinks.write_load(_normalised(spark, sf_dir), path)
    return normalise.load_summary(sinks.read_table(spark, path))


@query
def export_extract(spark, sf_dir):
    return _stored_csv(fx.sales_line(spark, sf_dir), "export")


@query
def extract_fingerprint(spark, sf_dir):
    return delimited.extract_fingerprint(delimited.export_rows(fx.sales_line(spark, sf_dir)))


@query
def evidence_sink(spark, sf_dir):
    path = scratch_path(spark, "evidence")
    report_ = profile.anomaly_report(fx.sales_line(spark, sf_dir))
    blocking = ("duplicate_source_row_id", "required_field_missing", "cancellation_prefix_mismatch")
    failed = report_.filter(F.col("check_name").isin(*blocking) & (F.col("observed_value") > 0))
    sinks.write_evidence(report_, path, "anomaly report", failed)
    results = spark.read.schema(report_.schema).json(f"{path}/results")
    status = spark.read.json(f"{path}/summary", schema="name string, status string, result_count bigint")
    return results.unionByName(status.select(F.concat_ws(": ", "name", "status").alias("check_name"), F.col("result_count").alias("observed_value")))


@query
def append_sheets(spark, sf_dir):
    rows = normalise.append_sheets(fx.raw_sales_sheets(spark, sf_dir), keep=["SourceRowId"])
    return rows.select("SourceRowId", "SourceSheet", "InvoiceNo", "UnitPrice", "CustomerID")


@query
def source_row_ids(spark, sf_dir):
    """Every observed row of two sheets numbered on, loaded or rejected."""
    rows = normalise.append_sheets(fx.raw_sales_sheets(spark, sf_dir), keep=[F.col("SourceRowId").alias("LineRef")], order=["SourceRowId"])
    return normalise.normalise_lines(rows, keep=("SourceRowId", "SourceSheet", "LineRef")).select(
        "SourceRowId", "SourceSheet", "LineRef", "InvoiceNo", "Quantity", "reject_code")


@query
def sheet_file_row_ids(spark, sf_dir):
    """The same from sheets kept as files, in which descriptions hold line breaks."""
    paths = {}
    for name, sheet in fx.raw_sales_sheets(spark, sf_dir).items():
        text = F.when(F.length("Description") % 4 == 0, F.concat("Description", F.lit('\n"'))).otherwise(F.col("Description"))
        one = sheet.withColumns({"Description": text, "InvoiceDate": F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss")})
        paths[name] = _stored_text(one.withColumnRenamed("SourceRowId", "LineRef"), "sheet", 4)
    rows = normalise.append_sheet_files(spark, paths)
    return normalise.normalise_lines(rows, keep=("SourceRowId", "SourceSheet")).select(
        "SourceRowId", "SourceSheet", "InvoiceNo", "StockCode", F.length("Description").alias("description_length"), "UnitPrice", "reject_code")


# ---- normalisation --------------------------------------------------------------

@query
def map_source_columns(spark, sf_dir):
    return _mapped_raw(spark, sf_dir)


@query
def clean_text(spark, sf_dir):
    return _mapped_raw(spark, sf_dir).select(
        "SourceRowId", T.clean_text(F.col("StockCode")).alias("StockCode"),
        T.text_or_null(F.col("Description")).alias("Description"), T.clean_text(F.col("Country")).alias("Country"),
    )


@query
def parse_quantity(spark, sf_dir):
    number = F.col("number")
    return _mapped_raw(spark, sf_dir).withColumn("number", N.parse_number(F.col("Quantity"))).select(
        "SourceRowId", exact.as_text(number).cast("double").alias("quantity_read"), N.quantity_issue(number).alias("quantity_issue")
    )


@query
def parse_unit_price(spark, sf_dir):
    number = F.col("number")
    return _mapped_raw(spark, sf_dir).withColumn("number", N.parse_number(F.col("UnitPrice"))).select(
        "SourceRowId", N.rounded_price(number).alias("UnitPrice"), (number["sign"] == 0).alias("ZeroPrice"),
        N.unit_price_issue(number).alias("price_issue"),
    )


@query
def canonical_customer_id(spark, sf_dir):
    return _mapped_raw(spark, sf_dir).select(
        "SourceRowId", T.canonical_customer_id(T.text_or_null(F.col("CustomerID"))).alias("CustomerID")
    )


@query
def parse_invoice_date(spark, sf_dir):
    rows = fx.raw_sales_text_dates(spark, sf_dir)
    parsed = normalise.parse_invoice_date(F.col("InvoiceDate"), "string")
    return rows.select(
        "SourceRowId", parsed.alias("parsed"),
        F.when(F.col("InvoiceDate").isNull(), "required_source_field_missing")
        .when(parsed.isNull(), "invoice_date_invalid").alias("date_issue"),
    )


@query
def classify_lines(spark, sf_dir):
    return normalise.loaded_lines(_normalised(spark, sf_dir))


@query
def reject_code(spark, sf_dir):
    return _normalised(spark, sf_dir).select("SourceRowId", "reject_code")


@query
def standardized_fact(spark, sf_dir):
    return star.standardized_fact(normalise.loaded_lines(_normalised(spark, sf_dir)))


@query
def model_fact(spark, sf_dir):
    return star.model_fact(fx.sales_line(spark, sf_dir))


@query
def year_month_key(spark, sf_dir):
    key = year_month(F.col("InvoiceDate")).alias("YearMonth")
    return fx.sales_line(spark, sf_dir).groupBy(key).agg(F.count("*").alias("line_count"))


@query
def month_offsets(spark, sf_dir):
    return periods.month_offsets(fx.sales_line(spark, sf_dir))


@query
def decimal_text(spark, sf_dir):
    return fx.sales_line(spark, sf_dir).select(
        "SourceRowId", N.decimal_text(F.col("LineAmount")).alias("amount_text"),
        N.decimal_text((F.col("LineAmount") / 8).cast("decimal(24,6)")).alias("eighth_text"),
        N.decimal_text(F.when(F.col("CustomerID").isNotNull(), F.col("UnitPrice")), "0.00").alias("price_text"),
    )


@query
def format_measure(spark, sf_dir):
    slices = measures.measures_all_slices(fx.sales_line(spark, sf_dir))
    return report.format_measures(slices, ["slice_id", "slice_value"])


# ---- filters and slices ---------------------------------------------------------

@query
def completed_lines(spark, sf_dir):
    return measures.completed_lines(fx.sales_line(spark, sf_dir)).select("SourceRowId", "InvoiceNo", "LineAmount")


@query
def cancelled_lines(spark, sf_dir):
    return measures.cancelled_lines(fx.sales_line(spark, sf_dir)).select("SourceRowId", "InvoiceNo", "LineAmount")


@query
def slice_metrics_country(spark, sf_dir):
    return measures.measures_for_country(fx.sales_line(spark, sf_dir), "NATION_2")


@query
def slice_metrics_month(spark, sf_dir):
    return measures.measures_for_month(fx.sales_line(spark, sf_dir), "1996-11")


@query
def slicer_filter(spark, sf_dir):
    chosen = report.slicer_filter(fx.sales_line(spark, sf_dir), {
        "YearMonth": ["1996-11", "1997-02", "1998-07"], "Country": ["NATION_2", "NATION_7"], "StockCode": [],
    })
    return chosen.select("SourceRowId", "InvoiceDate", "Country", "LineAmount")


@query
def slicer_values(spark, sf_dir):
    fact = fx.sales_line(spark, sf_dir)
    lists = [
        report.slicer_values(fact, field).select(F.lit(field).alias("field"), F.col(field).alias("member"))
        for field in report.SLICER_FIELDS
    ]
    result = lists[0]
    for more in lists[1:]:
        result = result.unionByName(more)
    return result


@query
def cross_filter(spark, sf_dir):
    chosen = report.cross_filter(
        fx.sales_line(spark, sf_dir), "CustomerID", None, {"Country": ["NATION_2", "NATION_7", "NATION_11"]}
    )
    return report.monthly_net_sales(chosen)


# ---- joins and security ---------------------------------------------------------

@query
def star_denormalize(spark, sf_dir):
    # The fact and all its dimensions come from one derivation.
    fact = stored(fx.sales_line(spark, sf_dir), "fact", codec="zstd")
    joined = star.star_denormalize(
        fact, star.dim_date(fact), star.dim_product(fact), star.dim_customer(fact), star.dim_country(fact)
    )
    return joined.select(
        "SourceRowId", "Year", "MonthNumber", "MonthName", "YearMonth", "ProductDescription",
        "CustomerKey", "IsUnknownCustomer", "Country", "CountryKnown", "LineAmount",
    )


@query
def rls_visible_countries(spark, sf_dir):
    countries = star.dim_country(fx.sales_line(spark, sf_dir))
    return security.rls_visible_countries(countries, fx.security_bridge(spark), USER)


@query
def rls_fact(spark, sf_dir):
    visible = security.rls_fact(fx.sales_line(spark, sf_dir), fx.security_bridge(spark), USER)
    return visible.select("SourceRowId", "Country", "LineAmount")


@query
def rls_scope_summary(spark, sf_dir):
    fact = fx.sales_line(spark, sf_dir)
    return security.rls_scope_summary(
        fact, star.dim_country(fact), fx.security_bridge(spark), fx.security_users(spark)
    )


@query
def referential_integrity(spark, sf_dir):
    fact = fx.sales_line(spark, sf_dir)
    return star.referential_integrity(fact, {
        "DimDate": star.dim_date(fact).filter("MonthNumber <> 2"),
        "DimProduct": star.dim_product(fact).filter("cast(StockCode as bigint) % 10 <> 3"),
        "DimCustomer": star.dim_customer(fact).filter("CustomerKey <> 'UNKNOWN'"),
        "DimCountry": star.dim_country(fact),
    })


@query
def key_uniqueness(spark, sf_dir):
    fact = fx.sales_line(spark, sf_dir)
    products, countries = star.dim_product(fact), star.dim_country(fact)
    return star.key_uniqueness({
        "DimDate": star.dim_date(fact),
        "DimProduct": products.unionByName(products.filter("cast(StockCode as bigint) % 10 = 3")),
        "DimCustomer": star.dim_customer(fact).withColumn("CustomerKey", F.col("CustomerID")),
        "DimCountry": countries,
    })


# ---- measures -------------------------------------------------------------------

@query
def metric_gross_sales(spark, sf_dir):
    return measures.sum_measure(fx.sales_line(spark, sf_dir), "gross_sales")


@query
def metric_cancelled_sales(spark, sf_dir):
    return measures.sum_measure(fx.sales_line(spark, sf_dir, mixed_signs=True), "cancelled_sales")


@query
def metric_net_sales(spark, sf_dir):
    return measures.sum_measure(fx.sales_line(spark, sf_dir, mixed_signs=True), "net_sales")


@query
def metric_units_sold(spark, sf_dir):
    return measures.sum_measure(fx.sales_line(spark, sf_dir), "units_sold")


@query
def metric_order_count(spark, sf_dir):
    return measures.distinct_measure(fx.sales_line(spark, sf_dir), "order_count")


@query
def metric_active_customers(spark, sf_dir):
    return measures.distinct_measure(fx.sales_line(spark, sf_dir), "active_customers")


@query
def metric_cancelled_invoices(spark, sf_dir):
    return measures.distinct_measure(fx.sales_line(spark, sf_dir), "cancelled_invoice_count")


@query
def metric_all_invoices(spark, sf_dir):
    return measures.distinct_measure(fx.sales_line(spark, sf_dir), "all_invoice_count")


@query
def metric_average_order_value(spark, sf_dir):
    return measures.average_order_value(fx.sales_line(spark, sf_dir), ["Country"])


@query
def metric_cancellation_rate(spark, sf_dir):
    return measures.cancellation_rate(fx.sales_line(spark, sf_dir), ["Country"])


@query
def base_metrics_all(spark, sf_dir):
    return measures.measures_by(fx.sales_line(spark, sf_dir))


@query
def base_metrics_mixed_signs(spark, sf_dir):
    return measures.measures_by(fx.sales_line(spark, sf_dir, mixed_signs=True))


@query
def metrics_all_slices(spark, sf_dir):
    return measures.measures_all_slices(fx.sales_line(spark, sf_dir))


@query
def country_baseline(spark, sf_dir):
    return measures.measures_by(fx.sales_line(spark, sf_dir), ["Country"])


@query
def aux_metrics(spark, sf_dir):
    return measures.auxiliary_measures(fx.sales_line(spark, sf_dir))


@query
def contract_metrics(spark, sf_dir):
    return metric_contract.contract_metrics(fx.contract_text(spark, sf_dir), METRIC_CONTRACT).select("metric_id", "actual", "issue")


@query
def metric_snapshot_check(spark, sf_dir):
    actual = metric_contract.contract_metrics(fx.contract_text(spark, sf_dir), METRIC_CONTRACT)
    return metric_contract.snapshot_check(actual, METRIC_CONTRACT).select("metric_id", "actual", "status", "issue")


@query
def dim_date(spark, sf_dir):
    return star.dim_date(fx.sales_line(spark, sf_dir))


@query
def dim_product(spark, sf_dir):
    return star.dim_product(fx.sales_line(spark, sf_dir))


@query
def dim_customer(spark, sf_dir):
    return star.dim_customer(fx.sales_line(spark, sf_dir))


@query
def dim_country(spark, sf_dir):
    return star.dim_country(fx.sales_line(spark, sf_dir))


@query
def table_profile(spark, sf_dir):
    return profile.table_profile(fx.raw_sales_line(spark, sf_dir))


# ---- time comparison ------------------------------------------------------------

@query
def sales_mom_pct(spark, sf_dir):
    return periods.monthly_changes(fx.gap_month_sales(spark, sf_dir)).select("YearMonth", "net_sales", "sales_mom_pct")


@query
def sales_yoy_pct(spark, sf_dir):
    changes = periods.monthly_changes(fx.gap_month_sales(spark, sf_dir), ["Country"])
    return changes.select("Country", "YearMonth", "net_sales", "sales_yoy_pct")


@query
def period_net_sales(spark, sf_dir):
    return periods.period_net_sales(fx.sales_line(spark, sf_dir), "1996-11", "NATION_2")


@query
def single_period_policy(spark, sf_dir):
    fact = fx.gap_month_sales(spark, sf_dir)
    scopes = {"one month": ["1997-03"], "two months": ["1997-03", "1997-04"], "after the gap": ["1996-06"],
              "absent month": ["1996-05"]}
    parts = [periods.changes_in_scope(fact, months).withColumn("scope", F.lit(name))
             for name, months in scopes.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# ---- ranked lists and pages -----------------------------------------------------

@query
def monthly_net_sales(spark, sf_dir):
    return report.monthly_net_sales(fx.sales_line(spark, sf_dir))


@query
def net_sales_by_country(spark, sf_dir):
    return report.net_sales_by(fx.sales_line(spark, sf_dir), "Country")


@query
def net_sales_by_product(spark, sf_dir):
    return report.net_sales_by(fx.sales_line(spark, sf_dir), "StockCode")


@query
def net_sales_by_customer(spark, sf_dir):
    return report.net_sales_by(fx.sales_line(spark, sf_dir), "CustomerID")


@query
def top_n_members(spark, sf_dir):
    fact = fx.sales_line(spark, sf_dir)
    top = report.top_n_members(fact, "StockCode", 5).withColumn("list", F.lit("top"))
    return top.unionByName(report.top_n_members(fact, "StockCode", 5, bottom=True).withColumn("list", F.lit("bottom")))


@query
def page_cards(spark, sf_dir):
    fact = fx.sales_line(spark, sf_dir)
    pages = [
        report.page_cards(fact, "Executive Overview", {"Country": ["NATION_2", "NATION_7"]}),
        report.page_cards(fact, "Product & Trend Analysis", {"YearMonth": ["1996-11"], "Country": ["NATION_2"]}),
        report.page_cards(fact, "Customer & Country Analysis", {"YearMonth": ["1996-11", "1996-12"]}),
    ]
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


@query
def product_cancellation_matrix(spark, sf_dir):
    return report.product_cancellation_matrix(fx.sales_line(spark, sf_dir))


@query
def schema_sample(spark, sf_dir):
    return report.schema_sample(fx.raw_sales_line(spark, sf_dir), 100, ["SourceRowId"])


# ---- data quality ---------------------------------------------------------------

def _row_check(*codes: str) -> Query:
    def build(spark, sf_dir):
        found = quality.row_issues(fx.contract_text(spark, sf_dir), CHECKED_CONTRACT, "LineRef", codes)
        return found.select("code", "scope", "row")
    return build


def _key_check(code: str) -> Query:
    def build(spark, sf_dir):
        table = stored(fx.contract_text(spark, sf_dir).select("LineRef", "SourceRowId"), "keyed", codec="zstd")
        found = quality.key_issues(table, CHECKED_CONTRACT, "LineRef", [code])
        return found.select("code", "scope", "row")
    return build


for _name, _build in {
    "dq_null_not_allowed": _row_check("null_not_allowed"),
    "dq_invalid_type": _row_check("invalid_type"),
    "dq_not_allowed": _row_check("not_allowed"),
    "dq_range": _row_check("below_minimum", "above_maximum"),
    "dq_formula_mismatch": _row_check("formula_mismatch"),
    "dq_formula_error": _row_check("formula_evaluation_error"),
    "dq_duplicate_primary_key": _key_check("duplicate_primary_key"),
    "dq_duplicate_unique_value": _key_check("duplicate_unique_value"),
}.items():
    QUERIES[_name] = _build


#: Source bytes for each file of a written text table.
FILE_BYTES = 8 << 20


def _stored_text(table: DataFrame, name: str, files: int) -> str:
    """A text table written as several files whose names and lines follow the order of LineRef.

    A task sorts and writes one file, so there are as many more as the sources are larger.
    """
    path = scratch_path(table.sparkSession, name)
    files = max(files, -(-source_bytes(table) // FILE_BYTES))
    kept = stored(table, "text", codec="zstd")
    delimited.write_in_order(kept, path, "LineRef", files, lineSep="\n")
    release(kept)
    return path


@query
def dq_missing_required_column(spark, sf_dir):
    """Columns that the header of a written file lacks."""
    path = _stored_text(fx.contract_text(spark, sf_dir).drop("Country", "Description"), "headless", 3)
    contract = {**CHECKED_CONTRACT, "expectations": {"min_rows": 1}}
    return quality.table_issues(delimited.scan_contract_csv(spark, path, row="row"), contract, "row").select("code", "scope")


@query
def dq_file_issue_list(spark, sf_dir):
    """Findings in an extract of several files with line breaks in cells, named by the row of the text."""
    table = fx.contract_text(spark, sf_dir)
    broken = F.when(F.length("Description") % 3 == 0, F.concat(F.lit('say "'), "Description", F.lit('",\n\n"now"'))).otherwise(F.col("Description"))
    path = _stored_text(table.withColumn("Description", broken), "extract", 5)
    scanned = delimited.scan_contract_csv(spark, path, row="row")
    return quality.issue_list(scanned, CHECKED_CONTRACT, "row").select("code", "scope", "row")


@query
def csv_read_errors(spark, sf_dir):
    """Rows of a written extract that have a cell too many or too few."""
    refs = fx.contract_text(spark, sf_dir).select("LineRef", "StockCode", "Country")
    stock = F.col("StockCode").cast("int")
    country = F.when(stock % 71 == 0, F.concat("Country", F.lit(",more"))).when(stock % 73 != 0, F.concat(F.lit('"a, ""'), "Country", F.lit('"""')))
    line = F.concat_ws(",", "LineRef", "StockCode", country)
    path = scratch_path(spark, "ragged")
    ordered = refs.select("LineRef", line.alias("LineRef,StockCode,Country")).repartitionByRange("LineRef").sortWithinPartitions("LineRef").drop("LineRef")
    # A delimiter and a quote that no line holds leave the lines as they are.
    ordered.write.option("header", True).option("sep", "\x01").option("quote", "\x02").csv(path)
    return delimited.csv_read_errors(spark, path).select("code", "row", "problem")


@query
def dq_row_count_bounds(spark, sf_dir):
    table = fx.contract_text(spark, sf_dir)
    bounds = [{"max_rows": 5000}, {"min_rows": 10**12}, {"min_rows": 1, "max_rows": 10**12}]
    checks = [
        quality.table_issues(table, {**SALES_CONTRACT, "expectations": bound}, "LineRef").select("code", "scope")
        for bound in bounds
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


@query
def dq_issue_list(spark, sf_dir):
    return quality.issue_list(fx.contract_text(spark, sf_dir), CHECKED_CONTRACT, "LineRef").select(
        "code", "scope", "row"
    )


WIDE_CONTRACT = {
    "dataset": {"primary_key": ["LineRef"]},
    "columns": [
        {"name": "LineRef", "type": "string"},
        {"name": "Serial", "type": "integer", "min": -(10**39) - 3 * 10**35, "max": 10**39 + 3 * 10**35},
        {"name": "Share", "type": "number", "min": "0.5000000000000000000000000000000000010", "max": "0.9"},
        {"name": "Units", "type": "integer"}, {"name": "Rate", "type": "number"}, {"name": "Amount", "type": "number"},
    ],
    "row_rules": [
        {"name": "amount", "type": "formula", "target": "Amount", "expression": "Units * Rate", "tolerance": "0.0000002"},
        {"name": "no_value", "type": "formula", "target": "Units", "expression": "1 / (Units - Units)", "tolerance": 0},
        {"name": "constants", "type": "formula", "target": "Units", "expression": "Units + (0.1 * 3 - 0.3) * 1e25", "tolerance": 0},
    ],
}


@query
def dq_long_numbers(spark, sf_dir):
    """Bounds of 40 digits, operands of 14 digits and differences in the seventh decimal."""
    found = quality.row_issues(fx.long_number_text(spark, sf_dir), WIDE_CONTRACT, "LineRef")
    return found.select("code", "scope", "row")


@query
def dq_issue_counts(spark, sf_dir):
    return quality.issue_counts(quality.issue_list(fx.contract_text(spark, sf_dir), CHECKED_CONTRACT, "LineRef"))


@query
def dq_summary(spark, sf_dir):
    table = fx.contract_text(spark, sf_dir)
    return quality.quality_summary(table, CHECKED_CONTRACT, "LineRef", locator_is_data=False)


@query
def anomaly_report(spark, sf_dir):
    fact = fx.sales_line(spark, sf_dir).withColumn("SourceRowId", F.substring_index("SourceRowId", "-", 2))
    return profile.anomaly_report(fact)


@query
def cancellation_prefix_mismatch(spark, sf_dir):
    # Unflagging cheap returns leaves prefixes without a flag.
    fact = fx.sales_line(spark, sf_dir).withColumn(
        "IsCancellation", F.col("IsCancellation") & (F.col("Quantity") < -3)
    )
    return profile.cancellation_prefix_mismatch(fact).select("SourceRowId", "InvoiceNo", "IsCancellation")


@query
def negative_quantity_mismatch(spark, sf_dir):
    found = profile.negative_quantity_mismatch(fx.sales_line(spark, sf_dir, mixed_signs=True))
    return found.select("SourceRowId", "Quantity", "IsCancellation")


@query
def repeated_source_rows(spark, sf_dir):
    return profile.repeated_source_rows(fx.sales_line(spark, sf_dir), ("StockCode", "Quantity", "UnitPrice", "CustomerID", "Country"))


@query
def product_display(spark, sf_dir):
    named = fx.contract_text(spark, sf_dir).select("StockCode", "Description")
    return profile.with_product_display(star.dim_product(named)).select("StockCode", "ProductDisplay")


@query
def description_length_guard(spark, sf_dir):
    return profile.description_length_guard(fx.sales_line(spark, sf_dir))


@query
def date_range_guard(spark, sf_dir):
    outside = profile.date_range_guard(fx.sales_line(spark, sf_dir), "1995-03-01", "2001-06-30")
    return outside.select("SourceRowId", "InvoiceDate")


# ---- reconciliation -------------------------------------------------------------

def _measure_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = measures.measures_all_slices(fx.sales_line(spark, sf_dir))
    return measures.long_measures(slices, ["slice_id", "slice_value"], value_type=reconcile.VALUE)


def _other_engine(values: DataFrame) -> DataFrame:
    """A second engine's results: small and large deviations, a NULL and a missing slice."""
    number = F.col("value").cast("decimal(28,10)")
    shift = (
        F.when(F.col("slice_value").isin("NATION_4", "NATION_8"), "0.005")
        .when(F.col("slice_value") == "NATION_6", "0.01")
        .when(F.col("slice_value").endswith("-06"), "0.5").otherwise("0").cast("decimal(10,4)")
    )
    shifted = F.when(~F.coalesce(F.col("slice_value") == "NATION_5", F.lit(False)), number + F.coalesce(shift, F.lit(0)))
    return values.filter(~F.coalesce(F.col("slice_value") == "NATION_3", F.lit(False))).withColumn("value", shifted)


@query
def reconcile_join(spark, sf_dir):
    values = _measure_set(spark, sf_dir)
    return reconcile.reconcile_join(values, _other_engine(values))


@query
def reconcile_metrics(spark, sf_dir):
    values = _measure_set(spark, sf_dir)
    return reconcile.reconcile_metrics(values, _other_engine(values)).select(
        "slice_id", "slice_value", "metric_id", "difference", "tolerance", "status"
    )


@query
def reconcile_slices(spark, sf_dir):
    values = _measure_set(spark, sf_dir)
    return reconcile.reconcile_slices(reconcile.reconcile_metrics(values, _other_engine(values)))


@query
def reconciliation_gate(spark, sf_dir):
    values = _measure_set(spark, sf_dir)
    results = reconcile.reconcile_metrics(values, _other_engine(values))
    return reconcile.reconciliation_gate(results, [*measures.REPORTED_MEASURES, "profit"])


@query
def measure_vs_baseline(spark, sf_dir):
    values = _measure_set(spark, sf_dir)
    return reconcile.measure_vs_baseline(values, _other_engine(values)).select(
        "slice_id", "slice_value", "metric_id", "difference", "status"
    )


@query
def rls_scenario_check(spark, sf_dir):
    fact = fx.sales_line(spark, sf_dir)
    summary = security.rls_scope_summary(
        fact, star.dim_country(fact), fx.security_bridge(spark), fx.security_users(spark)
    )
    wanted = fx.security_users(spark).withColumn(
        "expected_country", F.when(F.col("UserPrincipalName").startswith("manager.a"), "NATION_2")
        .when(F.col("UserPrincipalName").startswith("manager.b"), "NATION_7"),
    )
    baseline = measures.sum_measure(fact, "net_sales", ["Country"]).select(
        F.col("Country").alias("expected_country"), F.col("net_sales").alias("expected_net_sales")
    )
    expected = wanted.join(baseline, "expected_country", "left")
    return security.rls_scenario_check(summary, expected)
