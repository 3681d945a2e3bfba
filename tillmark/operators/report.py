"""Report queries: slicers, cross filters, ranked lists and page cards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.functions import numbers as N
from tillmark.functions.months import filter_months, in_month, month_start, year_month
from tillmark.operators.measures import (
    REPORTED_MEASURES, long_measures, measures_by, measures_for_month,
)
from tillmark.operators.periods import monthly_net
from tillmark.plans.contracts import MEASURE_FORMATS, PAGE_CARDS, PAGE_FILTERS

SLICER_FIELDS = ("YearMonth", "Country", "StockCode", "CustomerID")


def slicer_condition(field: str, values: Sequence[str | None]) -> Column:
    """In-list test that reaches the scan; months become ranges, None picks the blank member."""
    if field not in SLICER_FIELDS:
        raise ValueError(f"slicer_field_unknown: {field}")
    test = F.lit(False)
    named = [value for value in values if value is not None]
    if field == "YearMonth":
        for month in named:
            test = test | in_month(F.col("InvoiceDate"), month)
        return test
    if named:
        test = F.col(field).isin(*named)
    return test | F.col(field).isNull() if None in values else test


def slicer_filter(fact: DataFrame, selection: Mapping[str, Sequence[str | None]]) -> DataFrame:
    """Lines that match every field; an absent or empty field selects all."""
    for field, values in selection.items():
        if values and field == "YearMonth":
            fact = filter_months(fact, list(values))
        elif values:
            fact = fact.filter(slicer_condition(field, values))
    return fact


def slicer_values(fact: DataFrame, field: str) -> DataFrame:
    """Members of a slicer in order."""
    if field == "YearMonth":
        months = fact.select(month_start(F.col("InvoiceDate")).alias("Month")).distinct()
        return months.orderBy("Month").select(year_month(F.col("Month")).alias(field))
    return fact.select(field).distinct().orderBy(field)


def cross_filter(
    fact: DataFrame, field: str, member: str | None, selection: Mapping[str, Sequence[str | None]] | None = None,
) -> DataFrame:
    """Lines left for the other visuals after a chart member is picked on top of the slicers."""
    return slicer_filter(fact, {**(selection or {})}).filter(slicer_condition(field, [member]))


def monthly_net_sales(fact: DataFrame) -> DataFrame:
    """Net sales per month in time order."""
    return monthly_net(fact).orderBy("Month").select(year_month(F.col("Month")).alias("YearMonth"), "net_sales")


def net_sales_by(fact: DataFrame, field: str) -> DataFrame:
    """Net sales per member, largest first; equal members in key order."""
    totals = fact.groupBy(field).agg(F.sum("LineAmount").alias("net_sales"))
    return totals.orderBy(F.desc("net_sales"), F.asc(field))


def top_n_members(fact: DataFrame, field: str, n: int, bottom: bool = False) -> DataFrame:
    """The n largest or smallest members with their position.

    The limit runs as a per-partition top-n; only n rows reach the numbering window.
    """
    totals = fact.groupBy(field).agg(F.sum("LineAmount").alias("net_sales"))
    order = [F.asc("net_sales") if bottom else F.desc("net_sales"), F.asc(field)]
    return totals.orderBy(*order).limit(n).select(
        F.row_number().over(Window.orderBy(*order)).alias("position"), field, "net_sales"
    )


def product_cancellation_matrix(fact: DataFrame) -> DataFrame:
    """Net and cancelled sales and the number of cancelled lines per product."""
    amount, cancelled = F.col("LineAmount"), F.col("IsCancellation")
    return fact.groupBy("StockCode").agg(
        F.sum(amount).alias("net_sales"),
        F.coalesce(F.sum(F.when(cancelled, F.abs(amount))), F.lit(0)).alias("cancelled_sales"),
        F.count_if(cancelled).alias("cancelled_lines"),
    )


def page_cards(fact: DataFrame, page: str, selection: Mapping[str, Sequence[str | None]]) -> DataFrame:
    """Card values of a page under its slicers, one row per card.

    With one month selected, the changes compare with other months under the same
    remaining slicers; with none or several they are NULL.
    """
    unknown = set(selection) - set(PAGE_FILTERS[page])
    if unknown:
        raise ValueError(f"slicer_not_on_page: {sorted(unknown)}")
    cards = PAGE_CARDS[page]
    months = list(selection.get("YearMonth") or ())
    others = {field: values for field, values in selection.items() if field != "YearMonth"}
    scoped = slicer_filter(fact, others)
    if len(months) == 1:
        measures = measures_for_month(scoped, months[0])
    else:
        nothing = F.lit(None).cast("double")
        measures = measures_by(slicer_filter(scoped, {"YearMonth": months})).withColumns(
            {"sales_mom_pct": nothing, "sales_yoy_pct": nothing}
        )
    return long_measures(measures.withColumn("page", F.lit(page)), ["page"], cards)


def format_measures(measures: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Display text of every reported measure; a comparison that does not exist shows ``--``."""
    show = {"money": N.money_display, "count": N.count_display, "percent": N.percent_display}
    return measures.select(
        *keys,
        *[N.blank_display(show[MEASURE_FORMATS[name]](F.col(name))).alias(name) for name in REPORTED_MEASURES],
    )


def schema_sample(table: DataFrame, rows: int = 100, order: Sequence[str] = ()) -> DataFrame:
    """First rows of a table, in a stated order where there is one."""
    return (table.orderBy(*order) if order else table).limit(rows)
