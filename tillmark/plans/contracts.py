"""Column maps, data contracts, metric definitions, report pages."""

from __future__ import annotations

# Standard fields with the sheet headers they may come under, in order.
SHEET_ALIASES = {
    "InvoiceNo": ("InvoiceNo", "Invoice"),
    "StockCode": ("StockCode",),
    "Description": ("Description",),
    "Quantity": ("Quantity",),
    "InvoiceDate": ("InvoiceDate",),
    "UnitPrice": ("UnitPrice", "Price"),
    "CustomerID": ("CustomerID", "Customer ID"),
    "Country": ("Country",),
}

# The approved map from the raw table, which stores the text as DescriptionText.
RAW_TABLE_ALIASES = {**{name: (name,) for name in SHEET_ALIASES}, "Description": ("DescriptionText",)}

# Fact columns in export order.
FACT_COLUMNS = (
    "SourceRowId", "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
    "CustomerID", "Country", "IsCancellation", "UnknownCustomer", "ZeroPrice", "LineAmount",
)

# The data contract of the sales extract.
SALES_CONTRACT = {
    "dataset": {"name": "Retail sales lines",
                "primary_key": ["SourceRowId"]},
    "expectations": {},
    "columns": [
        {"name": "SourceRowId", "type": "string", "required": True, "nullable": False, "unique": True},
        {"name": "InvoiceNo", "type": "string", "required": True, "nullable": False},
        {"name": "StockCode", "type": "string", "required": True, "nullable": False},
        {"name": "Description", "type": "string", "required": False, "nullable": True},
        {"name": "Quantity", "type": "integer", "required": True, "nullable": False},
        {"name": "InvoiceDate", "type": "datetime", "format": "%Y-%m-%dT%H:%M:%S", "required": True,
         "nullable": False},
        {"name": "UnitPrice", "type": "number", "required": True, "nullable": False, "min": 0},
        {"name": "CustomerID", "type": "string", "required": False, "nullable": True},
        {"name": "Country", "type": "string", "required": True, "nullable": False},
        {"name": "IsCancellation", "type": "boolean", "required": True, "nullable": False},
        {"name": "UnknownCustomer", "type": "boolean", "required": True, "nullable": False},
        {"name": "ZeroPrice", "type": "boolean", "required": True, "nullable": False},
        {"name": "LineAmount", "type": "number", "required": True, "nullable": False},
    ],
    "row_rules": [
        {"name": "line_amount_reconciliation", "type": "formula", "target": "LineAmount",
         "expression": "Quantity * UnitPrice", "tolerance": 0.0001},
    ],
}

# Display format and reconciliation tolerance of each reported measure.
MEASURE_FORMATS = {
    "gross_sales": "money", "cancelled_sales": "money", "net_sales": "money",
    "order_count": "count", "units_sold": "count", "active_customers": "count",
    "average_order_value": "money", "cancellation_rate": "percent",
    "sales_mom_pct": "percent", "sales_yoy_pct": "percent",
}
RATIO_TOLERANCE = "0.0001"
AMOUNT_TOLERANCE = "0.01"
RATIO_MEASURES = ("cancellation_rate", "sales_mom_pct", "sales_yoy_pct")

# The measures each report page shows as cards, and its filter fields.
PAGE_CARDS = {
    "Executive Overview": (
        "net_sales", "order_count", "units_sold", "active_customers", "average_order_value", "cancellation_rate",
    ),
    "Product & Trend Analysis": (
        "net_sales", "units_sold", "cancelled_sales", "sales_mom_pct", "sales_yoy_pct",
    ),
    "Customer & Country Analysis": (
        "net_sales", "order_count", "active_customers", "average_order_value", "cancelled_sales", "cancellation_rate",
    ),
}
PAGE_FILTERS = {
    "Executive Overview": ("YearMonth", "Country"),
    "Product & Trend Analysis": ("YearMonth", "Country", "StockCode"),
    "Customer & Country Analysis": ("YearMonth", "Country", "CustomerID"),
}

# Longest product description the raw table takes.
DESCRIPTION_LIMIT = 512
