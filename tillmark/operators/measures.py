"""Sales measures over any grouping.

The measures mix sums with distinct counts of invoices and customers. Both come from one
scan: lines shrink to a row per invoice and customer that carries the sums and two flags.
It then becomes an invoice entry, which keeps the sums, and, for a completed sale to a
known customer, a customer entry. Grouped by entry, every distinct count becomes a plain
count of flags.

A stock plan with four ``count(distinct)`` would copy every line five times, amounts
included. Every step here combines on the map side, so an invoice, customer or country
with a large share of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.months import filter_months, in_month, year_month
from tillmark.functions.numbers import ratio, relative_change

BASE_MEASURES = (
    "gross_sales", "cancelled_sales", "net_sales", "order_count", "units_sold",
    "active_customers", "cancelled_invoice_count", "all_invoice_count",
)
RATIO_MEASURES = ("average_order_value", "cancellation_rate")
CHANGE_MEASURES = ("sales_mom_pct", "sales_yoy_pct")
REPORTED_MEASURES = (
    "gross_sales", "cancelled_sales", "net_sales", "order_count", "units_sold",
    "active_customers", "average_order_value", "cancellation_rate", "sales_mom_pct", "sales_yoy_pct",
)


def is_completed() -> Column:
    """A sale that went through: not cancelled, with positive quantity and price."""
    return ~F.col("IsCancellation") & (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0)


def is_cancelled() -> Column:
    return F.col("IsCancellation")


def completed_lines(fact: DataFrame) -> DataFrame:
    return fact.filter(is_completed())


def cancelled_lines(fact: DataFrame) -> DataFrame:
    return fact.filter(is_cancelled())


def _not_blank(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit("")).isNotNull()


# The measure plans are SQL text: one statement is parsed and analysed once, where building
# the same columns call by call took longer than running them on a small slice.
_LINES = """
  SELECT *, coalesce(NOT IsCancellation AND Quantity > 0 AND UnitPrice > 0, false) AS completed,
         coalesce(IsCancellation, false) AS cancelled
  FROM {fact}"""

_SUMS = """
  sum(LineAmount) FILTER (WHERE completed) AS gross_sales,
  sum(abs(LineAmount)) FILTER (WHERE cancelled) AS cancelled_sales,
  sum(LineAmount) AS net_sales,
  sum(CAST(Quantity AS BIGINT)) FILTER (WHERE completed) AS units_sold"""

# Orders count invoice numbers as written, all invoices count trimmed ones. A number with
# outer blanks therefore adds a second entry under its trimmed spelling.
_ENTRIES = """
  inline(CASE
    WHEN respelled AND buyer THEN array(named, other, known) WHEN buyer THEN array(named, known)
    WHEN respelled THEN array(named, other) ELSE array(named) END)
  FROM (
    SELECT *,
      coalesce(InvoiceNo <> nullif(trim(InvoiceNo), ''), false) AS respelled,
      completed AND coalesce(trim(CustomerID) <> '', false) AS buyer,
      struct(false AS is_customer, false AS is_other, InvoiceNo AS member, completed AND InvoiceNo IS NOT NULL AS ordered,
             cancelled AND InvoiceNo IS NOT NULL AS cancelled,
             coalesce(InvoiceNo = nullif(trim(InvoiceNo), ''), false) AS listed) AS named,
      struct(false AS is_customer, true AS is_other, trim(InvoiceNo) AS member, false AS ordered, false AS cancelled,
             true AS listed) AS other,
      struct(true AS is_customer, false AS is_other, CustomerID AS member, false AS ordered, false AS cancelled,
             false AS listed) AS known
    FROM {source})"""

_FLAGS = "max(ordered) AS ordered, max(cancelled) AS cancelled, max(listed) AS listed"

_COUNTS = """
  count_if(ordered) AS order_count, count_if(is_customer) AS active_customers,
  count_if(cancelled) AS cancelled_invoice_count, count_if(listed) AS all_invoice_count"""

# Lines shrink to one row per invoice and customer, which carries both the sums and the flags.
_INVOICES = f"""
  SELECT {{keys}}InvoiceNo, CustomerID, max(completed) AS completed, max(cancelled) AS cancelled, {_SUMS}
  FROM lines {{group}}"""

_AMOUNTS = ("gross_sales", "cancelled_sales", "net_sales", "units_sold")
# The entry of the number as written keeps the sums, so each amount is added once.
_CARRIED = ", ".join(f"CASE WHEN is_customer OR is_other THEN NULL ELSE {name} END AS {name}" for name in _AMOUNTS)
_ADDED = ", ".join(f"sum({name}) AS {name}" for name in _AMOUNTS)

_COMBINED = """
  SELECT *, try_divide(CAST(gross_sales AS DOUBLE), CAST(order_count AS DOUBLE)) AS average_order_value,
    try_divide(CAST(cancelled_invoice_count AS DOUBLE), CAST(all_invoice_count AS DOUBLE)) AS cancellation_rate
  FROM (
    SELECT {keys} CAST(coalesce(sum(gross_sales), 0) AS {amount}) AS gross_sales,
      CAST(coalesce(sum(cancelled_sales), 0) AS {amount}) AS cancelled_sales,
      CAST(coalesce(sum(net_sales), 0) AS {amount}) AS net_sales, count_if(ordered) AS order_count,
      coalesce(sum(units_sold), 0) AS units_sold, count_if(is_customer) AS active_customers,
      count_if(cancelled) AS cancelled_invoice_count, count_if(listed) AS all_invoice_count
    FROM members {group})"""


def _amount_type(fact: DataFrame) -> str:
    """The type of a plain sum of the line amounts, whatever the number of partial sums."""
    amount = fact.schema["LineAmount"].dataType
    return f"decimal({min(38, amount.precision + 10)},{amount.scale})" if hasattr(amount, "precision") else "double"


def _key_lists(keys: Sequence[str]) -> tuple[str, str]:
    """Select prefix and GROUP BY clause of a list of keys, which may be empty."""
    names = ", ".join(f"`{key}`" for key in keys)
    return (f"{names}, ", f"GROUP BY {names}") if keys else ("", "")


def _counts_sql(keys: Sequence[str]) -> str:
    prefix, group = _key_lists(keys)
    _, by_member = _key_lists([*keys, "is_customer", "member"])
    return (
        f"entries AS (SELECT {prefix}{_ENTRIES.replace('{source}', 'lines')}), "
        f"members AS (SELECT {prefix}is_customer, member, {_FLAGS} FROM entries {by_member}), "
        f"counts AS (SELECT {prefix}{_COUNTS} FROM members {group})"
    )


def with_ratios(measures: DataFrame) -> DataFrame:
    return measures.withColumns({
        "average_order_value": ratio(F.col("gross_sales"), F.col("order_count")),
        "cancellation_rate": ratio(F.col("cancelled_invoice_count"), F.col("all_invoice_count")),
    })


def measures_by(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Eight base measures and two ratios per group, from one scan; without keys, one row, also for no input."""
    prefix, group = _key_lists(keys)
    _, by_invoice = _key_lists([*keys, "InvoiceNo", "CustomerID"])
    _, by_member = _key_lists([*keys, "is_customer", "member"])
    amounts = ", ".join(_AMOUNTS)
    combined = _COMBINED.replace("{keys}", prefix).replace("{group}", group).replace("{amount}", _amount_type(fact))
    return fact.sparkSession.sql(
        f"WITH lines AS ({_LINES}), "
        f"invoices AS ({_INVOICES.replace('{keys}', prefix).replace('{group}', by_invoice)}), "
        f"entries AS (SELECT {prefix}{amounts}, {_ENTRIES.replace('{source}', 'invoices')}), "
        f"carried AS (SELECT {prefix}is_customer, member, ordered, cancelled, listed, {_CARRIED} FROM entries), "
        f"members AS (SELECT {prefix}is_customer, member, {_FLAGS}, {_ADDED} FROM carried {by_member}) {combined}",
        fact=fact,
    )


def member_tables(fact: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The sums of each group, and its members (is_customer, member) with the flags of the distinct counts."""
    prefix, group = _key_lists(keys)
    _, by_invoice = _key_lists([*keys, "InvoiceNo", "CustomerID"])
    _, by_member = _key_lists([*keys, "is_customer", "member"])
    invoices = f"WITH lines AS ({_LINES}), invoices AS ({_INVOICES.replace('{keys}', prefix).replace('{group}', by_invoice)})"
    amount = _amount_type(fact)
    added = ", ".join(f"CAST(sum({name}) AS {'bigint' if name == 'units_sold' else amount}) AS {name}" for name in _AMOUNTS)
    sums = fact.sparkSession.sql(f"{invoices} SELECT {prefix}{added} FROM invoices {group}", fact=fact)
    members = fact.sparkSession.sql(
        f"{invoices}, entries AS (SELECT {prefix}{_ENTRIES.replace('{source}', 'invoices')}) "
        f"SELECT {prefix}is_customer, member, {_FLAGS} FROM entries {by_member}", fact=fact)
    return sums, members


def sum_measure(fact: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """One of the measures that need no distinct count, in a single aggregate."""
    amount, completed = F.col("LineAmount"), is_completed()
    value = {
        "gross_sales": F.sum(F.when(completed, amount)),
        "cancelled_sales": F.sum(F.when(is_cancelled(), F.abs(amount))),
        "net_sales": F.sum(amount),
        "units_sold": F.sum(F.when(completed, F.col("Quantity").cast("bigint"))),
    }[name]
    return fact.groupBy(*keys).agg(F.coalesce(value, F.lit(0)).alias(name))


def distinct_measure(fact: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """One distinct-count measure; a single distinct needs no row copies."""
    completed = is_completed()
    member = {
        "order_count": F.when(completed, F.col("InvoiceNo")),
        "active_customers": F.when(completed & _not_blank("CustomerID"), F.col("CustomerID")),
        "cancelled_invoice_count": F.when(is_cancelled(), F.col("InvoiceNo")),
        "all_invoice_count": F.nullif(F.trim("InvoiceNo"), F.lit("")),
    }[name]
    return fact.groupBy(*keys).agg(F.count_distinct(member).alias(name))


def average_order_value(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Gross sales per completed invoice, from a per-invoice subtotal; NULL for a group without orders."""
    completed = F.coalesce(is_completed(), F.lit(False))
    orders = fact.groupBy(*keys, "InvoiceNo").agg(
        F.sum(F.when(completed, F.col("LineAmount"))).alias("amount"), F.max(completed).alias("ordered")
    )
    return orders.groupBy(*keys).agg(
        ratio(F.coalesce(F.sum("amount"), F.lit(0)), F.count(F.when(F.col("ordered"), F.col("InvoiceNo")))).alias("average_order_value")
    )


def cancellation_rate(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Cancelled invoices as a share of all invoices."""
    counts = fact.sparkSession.sql(f"WITH lines AS ({_LINES}), {_counts_sql(keys)} SELECT * FROM counts", fact=fact)
    return counts.select(
        *keys, ratio(F.col("cancelled_invoice_count"), F.col("all_invoice_count")).alias("cancellation_rate")
    )


def auxiliary_measures(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sales without a customer, and how many products and countries occur."""
    unknown = F.nullif(F.trim("CustomerID"), F.lit("")).isNull()
    # A small pre-aggregate per product and country replaces two row-copying distincts.
    pairs = fact.groupBy(*keys, "StockCode", "Country").agg(
        F.sum(F.when(unknown, F.col("LineAmount"))).alias("unknown_sales")
    )
    return pairs.groupBy(*keys).agg(
        F.coalesce(F.sum("unknown_sales"), F.lit(0)).alias("unknown_customer_sales"),
        F.count_distinct("StockCode").alias("product_count"),
        F.count_distinct("Country").alias("country_count"),
    )


# Bits of a member's flags, and in which order a slice meets the rows of a member.
_BITS = {"order_count": ("ordered", 1), "active_customers": ("is_customer", 2), "cancelled_invoice_count": ("cancelled", 4), "all_invoice_count": ("listed", 8)}
_SCOPES = {
    "all": "PARTITION BY is_customer, member ORDER BY Country, Month",
    "country": "PARTITION BY is_customer, member, Country ORDER BY Month",
    "month": "PARTITION BY is_customer, member, Month ORDER BY Country",
}


def measures_all_slices(fact: DataFrame) -> DataFrame:
    """The measures overall, per country and per month from one scan of the fact.

    ``slice_id`` is ``all``, ``country`` or ``month``; the change measures exist for months.
    Lines shrink to invoices, and these to a row per member, country and month. Windows find the
    row that shows a flag of its member first, overall, in the country and in the month; there the
    member counts. So no row is copied for a slice; sums per country and month enter the groupings.
    """
    from tillmark.operators.periods import with_changes

    amount = _amount_type(fact)
    # Named by grouping(), which stays right for rows whose country is NULL.
    slice_id = "CASE WHEN grouping(Country) = 0 THEN 'country' WHEN grouping(Month) = 0 THEN 'month' ELSE 'all' END"
    invoices = _INVOICES.replace("{keys}", "Country, Month, ").replace("{group}", "GROUP BY Country, Month, InvoiceNo, CustomerID")
    bits = " + ".join(f"CASE WHEN max({flag}) THEN {bit} ELSE 0 END" for flag, bit in _BITS.values())
    new = ", ".join(
        f"bits & ~coalesce(bit_or(bits) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS {scope}_bits"
        for scope, window in _SCOPES.items())
    counts = ", ".join(f"count_if({scope}_bits & {bit} <> 0) AS {scope}_{name}" for name, (_, bit) in _BITS.items() for scope in _SCOPES)
    chosen = ", ".join(f"CASE {slice_id} {' '.join(f"WHEN '{scope}' THEN sum({scope}_{name})" for scope in _SCOPES)} END AS {name}" for name in _BITS)
    types = {**dict.fromkeys(_AMOUNTS, amount), "units_sold": "bigint", **dict.fromkeys(_BITS, "bigint")}
    totals = ", ".join(f"CAST(coalesce(sum({name}), 0) AS {kind}) AS {name}" for name, kind in types.items())
    measures = fact.sparkSession.sql(f"""
        WITH lines AS ({_LINES.replace("SELECT *", "SELECT *, trunc(CAST(InvoiceDate AS DATE), 'MM') AS Month")}),
        invoices AS ({invoices}),
        entries AS (SELECT Country, Month, {", ".join(_AMOUNTS)}, {_ENTRIES.replace("{source}", "invoices")}),
        carried AS (SELECT Country, Month, is_customer, member, ordered, cancelled, listed, {_CARRIED} FROM entries),
        members AS (
          SELECT /*+ REPARTITION(is_customer, member) */ Country, Month, is_customer, member, {bits} AS bits, {_ADDED}
          FROM carried GROUP BY Country, Month, is_customer, member),
        marked AS (SELECT Country, Month, {", ".join(_AMOUNTS)}, {new} FROM members),
        months AS (SELECT Country, Month, {_ADDED}, {counts} FROM marked GROUP BY Country, Month),
        slices AS (
          SELECT {slice_id} AS slice_id, Country, Month, {_ADDED}, {chosen}
          FROM months GROUP BY GROUPING SETS ((), (Country), (Month))
          UNION ALL  -- the overall slice exists without any line
          SELECT 'all', NULL, NULL, {", ".join(["NULL"] * len(types))})
        SELECT *, try_divide(CAST(gross_sales AS DOUBLE), CAST(order_count AS DOUBLE)) AS average_order_value,
          try_divide(CAST(cancelled_invoice_count AS DOUBLE), CAST(all_invoice_count AS DOUBLE)) AS cancellation_rate
        FROM (SELECT slice_id, Country, Month, {totals} FROM slices GROUP BY slice_id, Country, Month)""", fact=fact)
    value = F.when(F.col("slice_id") == "country", F.col("Country")).otherwise(year_month(F.col("Month")))
    return with_changes(measures.withColumn("slice_value", value), "Month", "net_sales", ["slice_id"]).select(
        "slice_id", "slice_value", *BASE_MEASURES, *RATIO_MEASURES, *CHANGE_MEASURES
    )


def measures_for_country(fact: DataFrame, country: str) -> DataFrame:
    """The country slice; month-on-month and year-on-year do not apply."""
    nothing = F.lit(None).cast("double")
    return measures_by(fact.filter(F.col("Country") == country)).withColumns(
        {name: nothing for name in CHANGE_MEASURES}
    )


def measures_for_month(fact: DataFrame, month: str) -> DataFrame:
    """The month slice with its changes, reading only the three months it needs.

    A month without rows has zero sales, so it falls by 100 % against a month with sales.
    """
    moment = F.col("InvoiceDate")
    period = (
        F.when(in_month(moment, month), "current")
        .when(in_month(moment, month, -1), "previous")
        .when(in_month(moment, month, -12), "prior_year")
    )
    needed = filter_months(fact, [month], (0, -1, -12))
    by_period = measures_by(needed.withColumn("period", period), ["period"])

    def pick(name: str, wanted: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("period") == wanted, F.col(name))), F.lit(0))

    one_row = by_period.agg(
        *[pick(name, "current").alias(name) for name in BASE_MEASURES],
        pick("net_sales", "previous").alias("previous_net"),
        pick("net_sales", "prior_year").alias("prior_year_net"),
    )
    return with_ratios(one_row).select(
        *BASE_MEASURES, *RATIO_MEASURES,
        relative_change(F.col("net_sales"), F.col("previous_net")).alias("sales_mom_pct"),
        relative_change(F.col("net_sales"), F.col("prior_year_net")).alias("sales_yoy_pct"),
    )


def long_measures(measures: DataFrame, keys: Sequence[str], names: Sequence[str] = REPORTED_MEASURES, value_type: str = "double") -> DataFrame:
    """One row per key and measure; a decimal ``value_type`` keeps sums exact."""
    wide = measures.select(*keys, *[F.col(name).cast(value_type).alias(name) for name in names])
    return wide.unpivot([F.col(key) for key in keys], [F.col(name) for name in names], "metric_id", "value")
