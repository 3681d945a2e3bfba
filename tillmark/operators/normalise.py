"""Raw sheet rows to classified sales lines with coded rejects.

Everything is a chain of projections: no row is dropped or shuffled here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions import exact
from tillmark.functions import numbers as N
from tillmark.functions import text as T
from tillmark.operators.numbering import with_running_number
from tillmark.plans.contracts import SHEET_ALIASES
from tillmark.sources.delimited import scan_with_rows

LOADED_COLUMNS = (
    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
    "CustomerID", "Country", "IsCancellation", "UnknownCustomer", "ZeroPrice",
)


def map_source_columns(
    raw: DataFrame, aliases: Mapping[str, Sequence[str]] = SHEET_ALIASES, keep: Sequence[str | Column] = (),
) -> DataFrame:
    """Standard field names; the first alias that exists as a column wins, absent fields are NULL."""
    by_header = {header.strip(): header for header in raw.columns}

    def source(field: str) -> Column:
        found = next((by_header[alias] for alias in aliases[field] if alias in by_header), None)
        return F.lit(None).cast("string") if found is None else F.col(f"`{found}`")

    return raw.select(*keep, *[source(field).alias(field) for field in aliases])


def append_sheets(
    sheets: Mapping[str, DataFrame], aliases: Mapping[str, Sequence[str]] = SHEET_ALIASES, keep: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """Rows of all sheets under standard names, each marked with its SourceSheet.

    With an ``order``, columns that tell the rows of a sheet apart, every row also gets a SourceRowId. It
    runs on from 1 through the sheets as they are listed, and counts every observed row, so
    that rows rejected later leave gaps.
    """
    mapped = [
        map_source_columns(sheet, aliases, [*keep, *[F.col(f"`{name}`").alias(f"|{name}") for name in order]])
        .withColumns({"SourceSheet": F.lit(name), "|sheet": F.lit(place)})
        for place, (name, sheet) in enumerate(sheets.items())
    ]
    result = mapped[0]
    for sheet in mapped[1:]:
        result = result.unionByName(sheet)
    if not order:
        return result.drop("|sheet")
    extra = ["|sheet", *[f"|{name}" for name in order]]
    return with_running_number(result, [F.col(f"`{name}`") for name in extra], "SourceRowId").drop(*extra)


def append_sheet_files(
    spark: SparkSession, paths: Mapping[str, str], aliases: Mapping[str, Sequence[str]] = SHEET_ALIASES, delimiter: str = ",", encoding: str = "utf-8-sig",
) -> DataFrame:
    """Like :func:`append_sheets` for sheets kept as delimited files, numbered in the order of the text."""
    result, first = None, 1
    for name, path in paths.items():
        sheet, rows = scan_with_rows(spark, path, delimiter, encoding, "SourceRowId", first)
        first += rows
        if sheet.columns:
            mapped = map_source_columns(sheet, aliases, ["SourceRowId"]).withColumn("SourceSheet", F.lit(name))
            result = mapped if result is None else result.unionByName(mapped)
    if result is None:
        raise ValueError("sheets_without_header")
    return result


def parse_invoice_date(value: Column, data_type: str) -> Column:
    """Timestamp as recorded, without zone; ISO text with a full date is read, other text is NULL."""
    if data_type.startswith("timestamp") or data_type == "date":
        return value.cast("timestamp_ntz")
    return F.when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), value.try_cast("timestamp_ntz"))


def normalise_lines(mapped: DataFrame, keep: Sequence[str] = ("SourceRowId",)) -> DataFrame:
    """Loaded columns plus ``reject_code``, NULL for a row that loads.

    The first broken rule names the code. A missing quantity is an invalid one, and a row
    that is cancelled, free of charge or without a customer is kept and flagged.
    """
    date_type = mapped.schema["InvoiceDate"].dataType.simpleString()
    # Stage by stage, so that a cell is stripped once and parsed once.
    stripped = mapped.select(
        *keep, F.col("InvoiceDate").alias("date_read"),
        *[T.clean_text(F.col(name)).alias(name) for name in ("InvoiceNo", "StockCode", "Country")],
        *[T.text_or_null(F.col(name)).alias(name) for name in ("Description", "CustomerID")],
        *[T.stripped(F.col(name)).alias(name) for name in ("Quantity", "UnitPrice")],
    )
    parsed = stripped.select(
        *keep, "InvoiceNo", "StockCode", "Description", "Country",
        exact.number(F.col("Quantity")).alias("quantity_read"),
        F.col("date_read").isNull().alias("date_missing"),
        parse_invoice_date(F.col("date_read"), date_type).alias("InvoiceDate"),
        exact.number(F.col("UnitPrice")).alias("price_read"),
        T.canonical_customer_id(F.col("CustomerID")).alias("CustomerID"),
    )
    read = parsed.select(
        *keep, "InvoiceNo", "StockCode", "Description", "InvoiceDate", "CustomerID", "Country", "date_missing",
        N.without_fraction(F.col("quantity_read")).alias("whole_part"),
        exact.is_whole(F.col("quantity_read")).alias("is_whole"),
        N.rounded_price(F.col("price_read")).alias("UnitPrice"),
        F.col("price_read")["sign"].alias("price_sign"),
    )
    return read.select(
        *keep, "InvoiceNo", "StockCode", "Description",
        F.when(F.col("is_whole"), F.col("whole_part")).alias("Quantity"),
        "InvoiceDate", "UnitPrice", "CustomerID", "Country",
        F.upper("InvoiceNo").startswith("C").alias("IsCancellation"),
        F.col("CustomerID").isNull().alias("UnknownCustomer"),
        (F.col("price_sign") == 0).alias("ZeroPrice"),
        # A filter on a code that a generator gives is tested here, not taken apart and moved below the stages.
        F.explode(F.array(reject_code())).alias("reject_code"),
    )


def reject_code() -> Column:
    """First broken rule of a parsed row."""
    blank = (F.col("InvoiceNo") == "") | (F.col("StockCode") == "") | (F.col("Country") == "")
    return F.coalesce(
        F.when(blank | F.col("date_missing"), "required_source_field_missing"),
        N.quantity_code(F.col("whole_part"), F.col("is_whole")),
        N.unit_price_code(F.col("UnitPrice"), F.col("price_sign")),
        F.when(F.col("InvoiceDate").isNull(), "invoice_date_invalid"),
    )


def loaded_lines(normalised: DataFrame) -> DataFrame:
    return normalised.filter(F.col("reject_code").isNull()).drop("reject_code")


def rejected_lines(normalised: DataFrame) -> DataFrame:
    return normalised.filter(F.col("reject_code").isNotNull())


def load_summary(normalised: DataFrame) -> DataFrame:
    """Observed, loaded and rejected row counts, and rejects by code, from one aggregate."""
    status = F.when(F.col("reject_code").isNull(), "loaded").otherwise("rejected")
    counted = (
        normalised.select(status.alias("status"), "reject_code")
        .groupingSets([[], ["status"], ["status", "reject_code"]], "status", "reject_code")
        .agg(F.grouping("status").alias("all_rows"), F.grouping("reject_code").alias("all_codes"),
             F.count("*").alias("row_count"))
    )
    by_code = F.col("all_codes") == 0
    return counted.filter(~by_code | F.col("reject_code").isNotNull()).select(
        F.when(F.col("all_rows") == 1, "observed").when(~by_code, F.col("status")).otherwise("rejected_as")
        .alias("outcome"),
        F.coalesce("reject_code", F.lit("")).alias("reject_code"), "row_count",
    )
