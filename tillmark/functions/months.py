"""Calendar-month keys, ranges and shifts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(moment: Column) -> Column:
    """First day of the month: a 4-byte grouping key, formatted only after aggregation."""
    return F.trunc(moment.cast("date"), "MM")


def year_month(moment: Column) -> Column:
    """``YYYY-MM`` text key."""
    return F.date_format(moment.cast("date"), "yyyy-MM")


def shifted_month(moment: Column, months: int) -> Column:
    """``YYYY-MM`` of the month that lies ``months`` away."""
    return year_month(F.add_months(month_start(moment), months))


def month_index(day: Column) -> Column:
    """Months since year 0, so that neighbouring months differ by one."""
    return F.year(day) * 12 + F.month(day)


def month_bounds(text: str, shift: int = 0) -> tuple[date, date]:
    """First day of a ``YYYY-MM`` month moved by ``shift``, and of the month after it."""
    year, month = (int(part) for part in text.split("-"))
    if not 1 <= month <= 12:
        raise ValueError(f"month_invalid: {text}")
    index = year * 12 + month - 1 + shift
    return date(index // 12, index % 12 + 1, 1), date((index + 1) // 12, (index + 1) % 12 + 1, 1)


def in_month(moment: Column, text: str, shift: int = 0) -> Column:
    """Half-open range test, which reaches the parquet scan; a formatted text would not."""
    first, after = (F.lit(f"{day} 00:00:00").cast("timestamp_ntz") for day in month_bounds(text, shift))
    return (moment >= first) & (moment < after)


def filter_months(table: DataFrame, months: list[str], shifts: tuple[int, ...] = (0,)) -> DataFrame:
    """Rows of the given months and of the months ``shifts`` away from them.

    A stored model is partitioned by YearMonth, so there the other months are not even listed.
    """
    wanted = [(text, shift) for text in months for shift in shifts]
    if "YearMonth" in table.columns:
        keys = sorted({month_bounds(text, shift)[0].strftime("%Y-%m") for text, shift in wanted})
        table = table.filter(F.col("YearMonth").isin(*keys))
    test = F.lit(False)
    for text, shift in wanted:
        test = test | in_month(F.col("InvoiceDate"), text, shift)
    return table.filter(test)
