"""Metric contracts over text tables: sums, averages, distinct counts and ratios of them.

A row gives one entry per group of six digits of each summed column, and one per text of each counted
column. All metrics share one grouping of these entries, which combines on the map side;
then a handful of sums and the groups of each counted column are left. Sums are exact whatever the
length of the numbers, and nothing is compared as a double.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions import exact
from tillmark.functions.numbers import ratio
from tillmark.functions.text import text_or_null

AGGREGATIONS = ("sum", "average", "distinct_count", "ratio")


def _columns_of(metrics: Sequence[Mapping], *aggregations: str) -> list[str]:
    return sorted({m["column"] for m in metrics if m["aggregation"] in aggregations})


def _entries(table: DataFrame, summed: Sequence[str], counted: Sequence[str]) -> DataFrame:
    """(column, part, text, amount, filled, bad): what the cells of each row add to its columns' metrics."""
    names = sorted({*summed, *counted})
    texts = table.select(*[text_or_null(F.col(f"`{name}`")).alias(name) for name in names])
    read = texts.withColumns({f"{name}|number": exact.number(F.col(f"`{name}`")) for name in summed})
    far = {name: F.abs(F.col(f"`{name}|number`")["place"]) > exact.FAR for name in summed}

    def entry(name: str, part=None, text=None, amount=0, filled=0, bad=0) -> Column:
        cells = {"part": (part, "bigint"), "text": (text, "string"), "amount": (amount, "bigint"), "filled": (filled, "bigint"), "bad": (bad, "bigint")}
        return F.struct(F.lit(name).alias("column"), *[
            (value if isinstance(value, Column) else F.lit(value)).cast(kind).alias(key) for key, (value, kind) in cells.items()
        ])

    def sums(name: str) -> Column:
        text, number = F.col(f"`{name}`"), F.col(f"`{name}|number`")
        # The first limb also counts the cell.
        parts = F.transform(exact.limbs(number), lambda limb, i: entry(name, limb["part"], None, limb["amount"], F.when(i == 0, 1).otherwise(0)))
        return F.when(text.isNull(), F.array()).when(number.isNull() | far[name], F.array(entry(name, filled=1, bad=1))).otherwise(parts)

    def values(name: str) -> Column:
        return F.when(F.col(f"`{name}`").isNotNull(), F.array(entry(name, text=F.col(f"`{name}`")))).otherwise(F.array())

    arrays = [*(sums(name) for name in summed), *(values(name) for name in counted)]
    return read.select(F.inline(F.concat(*arrays) if len(arrays) > 1 else arrays[0]))


def _base(table: DataFrame, metrics: Sequence[Mapping]) -> DataFrame:
    """One row: filled, bad and the exact sum of each summed column, the number of texts of each counted one."""
    summed, counted = _columns_of(metrics, "sum", "average"), _columns_of(metrics, "distinct_count")
    if not summed and not counted:
        return table.groupBy().agg(F.lit(0).alias("none"))
    grouped = _entries(table, summed, counted).groupBy("column", "part", "text").agg(
        F.sum("amount").alias("amount"), F.sum("filled").alias("filled"), F.sum("bad").alias("bad"))

    def own(name: str, value: Column, test: Column | None = None) -> Column:
        here = F.col("column") == name
        return F.when(here if test is None else here & test, value)

    # A column has as many limbs as its numbers have digits, divided by six.
    wide = grouped.agg(*[
        column for name in summed for column in (
            F.coalesce(F.sum(own(name, F.col("filled"))), F.lit(0)).alias(f"{name}|filled"), F.coalesce(F.sum(own(name, F.col("bad"))), F.lit(0)).alias(f"{name}|bad"),
            F.collect_list(own(name, F.struct("part", "amount"), F.col("part").isNotNull())).alias(f"{name}|limbs"),
        )
    ], *[F.count(own(name, F.col("text"))).alias(f"{name}|texts") for name in counted])
    return wide.withColumns({f"{name}|sum": exact.from_limbs(F.col(f"`{name}|limbs`")) for name in summed})


def ratio_order(metrics: Sequence[Mapping]) -> tuple[list[Mapping], list[Mapping]]:
    """Ratios in an order that computes dependencies first, and those in a cycle or without one."""
    known = {metric["id"] for metric in metrics if metric["aggregation"] != "ratio"}
    waiting = [metric for metric in metrics if metric["aggregation"] == "ratio"]
    ordered: list[Mapping] = []
    while True:
        ready = [m for m in waiting if {m["numerator_metric"], m["denominator_metric"]} <= known]
        if not ready:
            return ordered, waiting
        ordered += ready
        known |= {metric["id"] for metric in ready}
        waiting = [metric for metric in waiting if metric not in ready]


def contract_metrics(table: DataFrame, metrics: Sequence[Mapping]) -> DataFrame:
    """``metric_id``, ``actual``, ``exact`` and ``issue`` per metric; a metric with an issue has no value.

    ``exact`` is the value as plain text: all digits of a sum or count, 28 or more of an average
    or ratio. ``actual`` is a double for display. A number whose first digit stands more than
    5,000 places from the point is an invalid input.
    """
    for metric in metrics:
        if metric["aggregation"] not in AGGREGATIONS:
            raise ValueError(f"unsupported_aggregation: {metric['aggregation']}")
    work = exact.Work(_base(table, metrics))
    shown: dict[str, Column] = {}
    values: dict[str, exact.Operand] = {}
    numbers: dict[str, Column] = {}
    issues: dict[str, Column] = {}
    for metric in metrics:
        name, kind = metric["id"], metric["aggregation"]
        if kind == "distinct_count":
            shown[name], numbers[name] = work.keep(F.col(f"`{metric['column']}|texts`").cast("double"), exact.number(F.col(f"`{metric['column']}|texts`").cast("string")))
            values[name], issues[name] = work.take(numbers[name]), F.lit(None).cast("string")
        elif kind in ("sum", "average"):
            filled, bad, total = (F.col(f"`{metric['column']}|{part}`") for part in ("filled", "bad", "sum"))
            (total,) = work.keep(F.when(bad == 0, total))
            numbers[name], values[name] = total, work.take(total)
            shown[name] = exact.as_text(total).cast("double")
            issues[name] = F.when(bad > 0, "invalid_metric_input")
            if kind == "average":
                values[name] = work.over(values[name], work.read(filled.cast("string")))
                numbers[name] = work.give(values[name])
                shown[name] = ratio(shown[name], filled)
                issues[name] = F.when(filled == 0, "empty_metric_input").otherwise(issues[name])
            (shown[name],) = work.keep(shown[name])
    ordered, stuck = ratio_order(metrics)
    for metric in ordered:
        name, upper, lower = metric["id"], metric["numerator_metric"], metric["denominator_metric"]
        issues[name] = F.when(values[upper].u.isNull() | values[lower].u.isNull(), "unresolved_metric_dependency").when(
            values[lower].u == 0, "zero_metric_denominator")
        values[name] = work.over(values[upper], values[lower])
        numbers[name] = work.give(values[name])
        (shown[name],) = work.keep(ratio(shown[upper], shown[lower]))
    for metric in stuck:
        name = metric["id"]
        shown[name], numbers[name] = F.lit(None).cast("double"), exact.number(F.lit(None).cast("string"))
        issues[name] = F.lit("unresolved_metric_dependency")
    return work.table.select(F.inline(F.array(*[
        F.struct(F.lit(m["id"]).alias("metric_id"), shown[m["id"]].alias("actual"), exact.plain_text(numbers[m["id"]]).alias("exact"), issues[m["id"]].alias("issue"))
        for m in metrics
    ])))


def _by_metric(metrics: Sequence[Mapping], value) -> Column:
    """A contract's own value for each metric."""
    cases = None
    for metric in metrics:
        test, own = F.col("metric_id") == metric["id"], value(metric)
        cases = F.when(test, own) if cases is None else cases.when(test, own)
    return cases


def snapshot_check(actual: DataFrame, metrics: Sequence[Mapping]) -> DataFrame:
    """Compare with the expected values, digit by digit; a difference equal to the tolerance passes."""
    read = lambda m, field: Decimal(str(m[field]))

    def edge(metric: Mapping, side: int) -> Column:
        expected, tolerance = read(metric, "expected"), read(metric, "tolerance")
        with localcontext() as context:
            # All digits of both.
            context.prec = 2 * exact.FAR + 100
            return exact.literal(expected + side * tolerance)

    work = exact.Work(actual.withColumn("read", exact.number(F.col("exact"))))
    low, high, expected = work.keep(
        _by_metric(metrics, lambda m: edge(m, -1)), _by_metric(metrics, lambda m: edge(m, 1)), _by_metric(metrics, lambda m: exact.literal(read(m, "expected"))))
    gap = work.size(work.minus(work.take(F.col("read")), work.take(expected)))
    value = F.col("read")
    outside = exact.below(value, low) | exact.below(high, value)
    status = F.when(value.isNull(), F.lit(None)).when(outside, "failed").otherwise("passed")
    return work.table.select(
        "metric_id", "actual", "exact", exact.as_text(expected).cast("double").alias("expected"), exact.as_text(gap).cast("double").alias("difference"),
        _by_metric(metrics, lambda m: F.lit(float(read(m, "tolerance")))).alias("tolerance"), status.alias("status"),
        F.coalesce("issue", F.when(status == "failed", "metric_mismatch")).alias("issue"),
    )
