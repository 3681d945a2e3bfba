"""Reconciling two sets of measures by slice and metric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.plans.contracts import AMOUNT_TOLERANCE, RATIO_MEASURES, RATIO_TOLERANCE

VALUE = "decimal(38,10)"


def reconcile_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = ("slice_id", "slice_value"),
) -> DataFrame:
    """Both values per slice and metric, keeping metrics that only one side has.

    Union and group, so NULL slice values meet and each side is read once.
    """
    on = [*keys, "metric_id"]

    def side(table: DataFrame, is_left: bool) -> DataFrame:
        value, none = F.col("value").cast(VALUE), F.lit(None).cast(VALUE)
        return table.select(
            *on, (value if is_left else none).alias("left_value"), (none if is_left else value).alias("right_value"),
            F.lit(is_left).alias("in_left"), F.lit(not is_left).alias("in_right"),
        )

    return side(left, True).unionByName(side(right, False)).groupBy(*on).agg(
        F.max("left_value").alias("left_value"), F.max("right_value").alias("right_value"),
        F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"),
    )


def metric_tolerance() -> Column:
    """0.0001 for the rate and the two changes, 0.01 for everything else."""
    text = F.when(F.col("metric_id").isin(*RATIO_MEASURES), RATIO_TOLERANCE).otherwise(AMOUNT_TOLERANCE)
    return text.cast("decimal(5,4)")


def _compared(joined: DataFrame, tolerance: Column) -> DataFrame:
    left, right = F.col("left_value"), F.col("right_value")
    difference = F.abs(left - right)
    status = (
        F.when(left.isNull() & right.isNull(), "both-null")
        .when(left.isNull() | right.isNull(), "null-mismatch")
        .when(difference <= tolerance, "passed").otherwise("failed")
    )
    return joined.withColumns({"difference": difference, "tolerance": tolerance, "status": status})


def reconcile_metrics(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = ("slice_id", "slice_value"),
) -> DataFrame:
    """Difference and status per slice and metric; a difference equal to the tolerance passes."""
    return _compared(reconcile_join(left, right, keys), metric_tolerance())


def measure_vs_baseline(
    actual: DataFrame, baseline: DataFrame, keys: Sequence[str] = ("slice_id", "slice_value"),
) -> DataFrame:
    """Second engine against the baseline: 0.0001 for every measure, NULL equals only NULL."""
    return _compared(reconcile_join(actual, baseline, keys), F.lit("0.0001").cast("decimal(5,4)"))


def _accepted() -> Column:
    return F.col("status").isin("passed", "both-null")


def reconcile_slices(results: DataFrame, keys: Sequence[str] = ("slice_id", "slice_value")) -> DataFrame:
    """A slice passes when all its metrics do."""
    return results.groupBy(*keys).agg(
        F.count("*").alias("metric_count"), F.count_if(~_accepted()).alias("failed_count"),
        F.when(F.bool_and(_accepted()), "passed").otherwise("failed").alias("status"),
    )


def reconciliation_status(results: DataFrame) -> DataFrame:
    """Overall status; without any slice the gate does not pass."""
    return results.agg(
        F.when(F.bool_and(_accepted()), "passed").otherwise("failed").alias("status")
    )


def reconciliation_gate(
    results: DataFrame, expected_ids: Sequence[str], keys: Sequence[str] = ("slice_id", "slice_value"),
) -> DataFrame:
    """What keeps the gate closed; no row means it is open.

    ``baseline_metric_failed`` names an expected metric that a slice lacks or fails, and
    ``baseline_slice_failed`` a slice with any failed metric, expected or not.
    ``baseline_slices_missing`` says that nothing was compared, and
    ``baseline_reconciliation_failed`` that the whole did not pass; both name no slice.
    """
    wanted = F.array(*[F.lit(name) for name in expected_ids])
    per_slice = results.groupBy(*keys).agg(
        F.collect_set(F.when(_accepted() & F.col("metric_id").isin(*expected_ids), F.col("metric_id"))).alias("good"),
        F.bool_and(_accepted()).alias("passed"),
    )
    missing = per_slice.select(*keys, F.explode(F.array_except(wanted, F.col("good"))).alias("metric_id")).withColumn(
        "code", F.lit("baseline_metric_failed")
    )
    nothing = F.lit(None).cast("string").alias("metric_id")
    failed = per_slice.where(~F.col("passed")).select(*keys, nothing, F.lit("baseline_slice_failed").alias("code"))
    codes = F.when(F.col("n") == 0, F.array(F.lit("baseline_reconciliation_failed"), F.lit("baseline_slices_missing"))).when(
        ~F.col("passed"), F.array(F.lit("baseline_reconciliation_failed"))
    ).otherwise(F.array().cast("array<string>"))
    whole = per_slice.agg(F.count("*").alias("n"), F.bool_and("passed").alias("passed")).select(
        *[F.lit(None).cast(results.schema[key].dataType).alias(key) for key in keys], nothing, F.explode(codes).alias("code")
    )
    return missing.unionByName(failed).unionByName(whole)
