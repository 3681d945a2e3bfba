from decimal import Decimal

import pytest

from tillmark.operators import normalise

SHEET = "SourceRowId string, Invoice string, StockCode string, Description string, Quantity string, " \
        "InvoiceDate string, Price string, `Customer ID` string, Country string"
LINE = dict(SourceRowId="1", Invoice="536365", StockCode="85123A", Description="LAMP", Quantity="6",
            InvoiceDate="2009-12-01 08:26:00", Price="2.55", **{"Customer ID": "14527"}, Country="United Kingdom")


def one(spark, **changes):
    row = {**LINE, **changes}
    raw = spark.createDataFrame([tuple(row[name] for name in row)], SHEET)
    return normalise.normalise_lines(normalise.map_source_columns(raw, keep=["SourceRowId"])).first()


def test_cancellation_is_kept_and_flagged(spark):
    line = one(spark, Invoice="c536379", Quantity="-1", Price="27.50")
    assert (line.reject_code, line.IsCancellation, line.Quantity) == (None, True, -1)


def test_missing_customer_is_kept_as_unknown(spark):
    line = one(spark, **{"Customer ID": None})
    assert (line.reject_code, line.CustomerID, line.UnknownCustomer) == (None, None, True)


@pytest.mark.parametrize("text, key", [
    ("14527.0", "14527"), (" 0014527 ", "14527"), ("+7", "7"), ("-0", "0"), ("-5.00", "-5"), ("1e3", "1000"),
    ("12.", "12"), ("12.5", "12.5"), ("A-7", "A-7"), (" \t", None), ("0" * 30 + "1234567890123456789012345", "1234567890123456789012345"),
])
def test_customer_key(spark, text, key):
    assert one(spark, **{"Customer ID": text}).CustomerID == key


@pytest.mark.parametrize("price, stored, zero", [
    ("0", "0.0000", True), ("0.004", "0.0000", False), ("2.345", "2.3400", False), ("2.355", "2.3600", False),
    ("0.00500001", "0.0100", False), ("1e2", "100.0000", False),
])
def test_price_rounds_half_even_and_zero_is_judged_before(spark, price, stored, zero):
    line = one(spark, Price=price)
    assert (line.UnitPrice, line.ZeroPrice) == (Decimal(stored), zero)


@pytest.mark.parametrize("changes, code", [
    ({"Invoice": "  "}, "required_source_field_missing"),
    ({"Country": None, "Quantity": "two"}, "required_source_field_missing"),
    ({"InvoiceDate": None}, "required_source_field_missing"),
    ({"Quantity": None}, "quantity_invalid"), ({"Quantity": "two", "Price": "-1"}, "quantity_invalid"),
    ({"Quantity": "1e19"}, "quantity_invalid"), ({"Quantity": "1.5"}, "quantity_not_integral"),
    ({"Price": "n/a"}, "unit_price_invalid"), ({"Price": ""}, "unit_price_invalid"),
    ({"Price": "-1"}, "unit_price_negative"), ({"InvoiceDate": "soon"}, "invoice_date_invalid"),
    ({"InvoiceDate": "2009"}, "invoice_date_invalid"), ({"Quantity": "6.0"}, None), ({"InvoiceDate": "2009-12-01"}, None),
])
def test_first_broken_rule_names_the_code(spark, changes, code):
    assert one(spark, **changes).reject_code == code


def test_first_alias_present_wins_even_when_blank(spark):
    raw = spark.createDataFrame([("a", None, "x")], "Price string, UnitPrice string, ` Invoice ` string")
    mapped = normalise.map_source_columns(raw).first()
    assert (mapped.UnitPrice, mapped.InvoiceNo, mapped.Country) == (None, "x", None)


def test_raw_table_spelling_of_description(spark):
    from tillmark.plans.contracts import RAW_TABLE_ALIASES

    raw = spark.createDataFrame([("LAMP",)], "DescriptionText string")
    assert normalise.map_source_columns(raw, RAW_TABLE_ALIASES).first().Description == "LAMP"


def test_the_filter_on_loaded_rows_reads_no_number_again(spark):
    raw = spark.createDataFrame([tuple(LINE.values())], SHEET)
    loaded = normalise.loaded_lines(normalise.normalise_lines(normalise.map_source_columns(raw, keep=["SourceRowId"])))
    # Once for the quantity and once for the price, however the filter is placed.
    assert loaded._jdf.queryExecution().optimizedPlan().toString().count("{1,18}") == 2
    assert loaded.count() == 1
