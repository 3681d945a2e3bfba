"""Measures kept at the grain that every slice and page reads.

Two small tables stand in for the lines. *Cells* hold the four sums of each country and month.
*Members* hold each invoice number and each customer once per country and month, with the flags that
the distinct counts need. Sums add up over cells; a count takes each member of the slice once.

Both are kept by month, and a refresh of some months replaces those folders alone. In
memory, members lie by their name, so a slice counts them without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.months import filter_months, month_bounds, year_month
from tillmark.operators.measures import BASE_MEASURES, CHANGE_MEASURES, RATIO_MEASURES, member_tables
from tillmark.sources.scratch import drop_scratch

AMOUNTS = ("gross_sales", "cancelled_sales", "net_sales", "units_sold")


@dataclass(frozen=True)
class MeasureStore:
    cells: DataFrame
    members: DataFrame

    def in_memory(self, parts: int) -> MeasureStore:
        """The store held by the executors, members dealt by name over some parts."""
        cells = self.cells.coalesce(1).persist()
        members = self.members.repartition(parts, "is_customer", "member").persist()
        cells.count(), members.count()
        return MeasureStore(cells, members)

    def release(self) -> None:
        self.cells.unpersist()
        self.members.unpersist()


def build_store(fact: DataFrame) -> MeasureStore:
    """Cells and members of a fact, not stored."""
    return MeasureStore(*member_tables(fact.withColumn("YearMonth", year_month(F.col("InvoiceDate"))), ["Country", "YearMonth"]))


def refresh_store(fact: DataFrame, path: str, months: Sequence[str] | None = None) -> MeasureStore:
    """Writes the store of a fact, or of its ``months`` alone, in which case the others stay as they are.

    A named month without lines loses its folder. Lines without a date make a month of their
    own, which is null and part of a full refresh only.
    """
    spark = fact.sparkSession
    built = build_store(fact if months is None else filter_months(fact, list(months)))
    tables = {}
    for name, table in vars(built).items():
        writer = table.hint("rebalance", "YearMonth").write.mode("overwrite").partitionBy("YearMonth")
        writer.option("partitionOverwriteMode", "static" if months is None else "dynamic").parquet(f"{path}/{name}")
        tables[name] = spark.read.schema(table.schema).parquet(f"{path}/{name}")
    if months is not None:
        # One row per month.
        present = {r.YearMonth for r in filter_months(fact, list(months)).select(year_month(F.col("InvoiceDate")).alias("YearMonth")).distinct().collect()}
        for month in set(months) - present:
            for name in tables:
                drop_scratch(spark, f"{path}/{name}/YearMonth={month}")
        tables = {name: spark.read.schema(table.schema).parquet(f"{path}/{name}") for name, table in tables.items()}
    return MeasureStore(**tables)


def open_store(spark: SparkSession, path: str) -> MeasureStore:
    return MeasureStore(*[spark.read.parquet(f"{path}/{name}") for name in ("cells", "members")])


def _in(column: str, values: Sequence[str] | None) -> str:
    if values is None:
        return "true"
    texts = [f"'{value}'" for value in (value.replace("\\", "\\\\").replace("'", "\\'") for value in values)]
    return f"{column} IN ({', '.join(texts)})" if texts else "false"


def _combined(store: MeasureStore, keys: Sequence[str], countries: Sequence[str] | None, months: Sequence[str] | None, shifts: Sequence[str] = ()) -> DataFrame:
    """One statement with one exchange: cells bring sums, members flags, and both end in the same aggregate.

    For a single month, ``shifts`` are months whose net sales come along as ``net_0``, ``net_1``.
    """
    prefix = "".join(f"{key}, " for key in keys)
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    at_home = _in("YearMonth", months)
    kinds = {name: store.cells.schema[name].dataType.simpleString() for name in AMOUNTS}
    sums = ", ".join(f"CAST(coalesce(sum({name}) FILTER (WHERE own), 0) AS {kinds[name]}) AS {name}" for name in AMOUNTS)
    nets = "".join(f", coalesce(sum(net_sales) FILTER (WHERE YearMonth = '{month}'), 0) AS net_{i}" for i, month in enumerate(shifts))
    months_read = at_home if not shifts else _in("YearMonth", [*(months or ()), *shifts])
    flags = "max(ordered) AS ordered, max(cancelled) AS cancelled, max(listed) AS listed"
    none = ", ".join(f"CAST(NULL AS {kinds[name]}) AS {name}" for name in AMOUNTS)
    outer = [*dict.fromkeys([*keys, "YearMonth"])]
    inner = ", ".join(key if key in keys else f"CAST(NULL AS STRING) AS {key}" for key in outer)
    return store.cells.sparkSession.sql(f"""
        SELECT {prefix}gross_sales, cancelled_sales, net_sales, order_count, units_sold, active_customers, cancelled_invoice_count, all_invoice_count,
          try_divide(CAST(gross_sales AS DOUBLE), CAST(order_count AS DOUBLE)) AS average_order_value,
          try_divide(CAST(cancelled_invoice_count AS DOUBLE), CAST(all_invoice_count AS DOUBLE)) AS cancellation_rate
          {''.join(f', net_{i}' for i in range(len(shifts)))}
        FROM (
          SELECT {prefix}{sums}, count_if(ordered) AS order_count, count_if(is_customer) AS active_customers,
            count_if(cancelled) AS cancelled_invoice_count, count_if(listed) AS all_invoice_count{nets}
          FROM (
            SELECT {', '.join(outer)}, {', '.join(AMOUNTS)}, {at_home} AS own, false AS is_customer, false AS ordered, false AS cancelled, false AS listed
            FROM {{cells}} WHERE {_in('Country', countries)} AND {months_read}
            UNION ALL
            SELECT {inner}, {none}, false, is_customer, {flags}
            FROM {{members}} WHERE {_in('Country', countries)} AND {at_home} GROUP BY {prefix}is_customer, member)
          {group})""", cells=store.cells, members=store.members)


def store_measures(store: MeasureStore, keys: Sequence[str] = (), countries: Sequence[str] | None = None, months: Sequence[str] | None = None) -> DataFrame:
    """Eight base measures and two ratios per group of ``keys`` (Country, YearMonth), of some countries and months.

    Equal to the measures of the lines themselves. Without keys there is one row, also for no line.
    """
    return _combined(store, keys, countries, months)


def store_country(store: MeasureStore, country: str) -> DataFrame:
    """The country slice; month-on-month and year-on-year do not apply."""
    return store_measures(store, countries=[country]).selectExpr("*", *[f"CAST(NULL AS DOUBLE) AS {name}" for name in CHANGE_MEASURES])


def store_month(store: MeasureStore, month: str) -> DataFrame:
    """The month slice with its changes; of the two months that it is compared with only cells are read."""
    shifts = [month_bounds(month, shift)[0].isoformat()[:7] for shift in (-1, -12)]
    one = _combined(store, (), None, [month], shifts)
    change = "try_divide(CAST(net_sales - net_{0} AS DOUBLE), CAST(net_{0} AS DOUBLE)) AS {1}"
    return one.selectExpr(*BASE_MEASURES, *RATIO_MEASURES, *[change.format(i, name) for i, name in enumerate(CHANGE_MEASURES)])
