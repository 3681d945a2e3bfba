"""Month-on-month and year-on-year comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.functions.months import filter_months, in_month, month_index, month_start, shifted_month, year_month
from tillmark.functions.numbers import relative_change


def with_changes(monthly: DataFrame, month: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add both changes to a table with one row per key and month.

    The frame reaches back by calendar months, so a missing month gives NULL where
    ``lag`` would take an older one. A window holds at most one row per month.
    """
    ordered = Window.partitionBy(*keys).orderBy(month_index(F.col(month)))
    back = lambda months: F.sum(value).over(ordered.rangeBetween(-months, -months))
    # Rows that belong to no month are not neighbours of each other.
    change = lambda months: F.when(F.col(month).isNotNull(), relative_change(F.col(value), back(months)))
    return monthly.withColumns({"sales_mom_pct": change(1), "sales_yoy_pct": change(12)})


def monthly_net(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Net sales per key and month; ``Month`` is the first day."""
    return fact.groupBy(*keys, month_start(F.col("InvoiceDate")).alias("Month")).agg(
        F.sum("LineAmount").alias("net_sales")
    )


def monthly_changes(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Net sales per month with both changes."""
    return with_changes(monthly_net(fact, keys), "Month", "net_sales", keys).select(
        *keys, year_month(F.col("Month")).alias("YearMonth"), "net_sales", "sales_mom_pct", "sales_yoy_pct"
    )


def period_net_sales(fact: DataFrame, month: str, country: str | None = None) -> DataFrame:
    """Net sales of one month, zero when there are none."""
    chosen = filter_months(fact, [month])
    if country is not None:
        chosen = chosen.filter(F.col("Country") == country)
    return chosen.agg(F.coalesce(F.sum("LineAmount"), F.lit(0)).alias("net_sales"))


def changes_in_scope(fact: DataFrame, months: Sequence[str]) -> DataFrame:
    """Both changes for a selection of months: defined only when one month is in scope.

    A selected month counts when any line falls in it.
    """
    moment = F.col("InvoiceDate")
    selected = F.lit(False)
    for text in months:
        selected = selected | in_month(moment, text)
    needed = filter_months(fact, list(months), (0, -1, -12))
    by_month = monthly_net(needed.withColumn("InScope", selected), ["InScope"])
    with_all = with_changes(
        by_month.groupBy("Month").agg(F.sum("net_sales").alias("net_sales"), F.bool_or("InScope").alias("InScope")),
        "Month", "net_sales",
    ).filter("InScope")
    single = F.count("*") == 1
    return with_all.agg(
        F.count("*").alias("months_in_scope"),
        F.sum("net_sales").alias("net_sales"),
        F.when(single, F.max("sales_mom_pct")).alias("sales_mom_pct"),
        F.when(single, F.max("sales_yoy_pct")).alias("sales_yoy_pct"),
    )


def month_offsets(fact: DataFrame) -> DataFrame:
    """Each month that occurs with the month before it and the same month a year earlier."""
    months = fact.select(month_start(F.col("InvoiceDate")).alias("Month")).distinct()
    return months.select(
        year_month(F.col("Month")).alias("YearMonth"),
        shifted_month(F.col("Month"), -1).alias("PreviousMonth"),
        shifted_month(F.col("Month"), -12).alias("PriorYearMonth"),
    )
