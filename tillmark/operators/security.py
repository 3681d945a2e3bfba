"""Row-level security by country: what a user may see, deny by default."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def granted_countries(bridge: DataFrame, user: str) -> DataFrame:
    """Countries with an active grant for the user; a grant listed twice counts once."""
    active = bridge.filter(F.col("IsActive") & (F.col("UserPrincipalName") == user))
    return active.select("Country").distinct()


def rls_visible_countries(countries: DataFrame, bridge: DataFrame, user: str) -> DataFrame:
    return countries.join(granted_countries(bridge, user), "Country", "left_semi")


def rls_fact(fact: DataFrame, bridge: DataFrame, user: str) -> DataFrame:
    """Lines of the granted countries. A semi join, so grants cannot multiply lines."""
    return fact.join(granted_countries(bridge, user), "Country", "left_semi")


def rls_scope_summary(fact: DataFrame, countries: DataFrame, bridge: DataFrame, users: DataFrame) -> DataFrame:
    """Visible countries and net sales per user; all NULL for a user who sees nothing.

    Sales are summed per country before any user is involved, so the cost does not grow
    with the number of users per country.
    """
    grants = bridge.filter("IsActive").select("UserPrincipalName", "Country").distinct()
    visible = grants.join(countries.select("Country").distinct(), "Country")
    by_country = fact.groupBy("Country").agg(F.sum("LineAmount").alias("country_sales"))
    scope = (
        visible.join(by_country, "Country", "left").groupBy("UserPrincipalName").agg(
            F.count("*").alias("visible_country_count"),
            F.array_join(F.array_sort(F.collect_list("Country")), "|").alias("visible_countries"),
            F.sum("country_sales").alias("net_sales"),
        )
    )
    return users.select("UserPrincipalName").distinct().join(scope, "UserPrincipalName", "left")


def rls_scenario_check(summary: DataFrame, expected: DataFrame) -> DataFrame:
    """Compare each user's scope with the one country (or none) it should show.

    ``expected`` has UserPrincipalName, expected_country and expected_net_sales; NULL means
    nothing may be visible. Net sales must lie within less than 0.01.
    """
    joined = expected.join(summary, "UserPrincipalName", "left")
    denied = F.col("expected_country").isNull()
    visible_right = F.when(
        denied, F.coalesce("visible_country_count", F.lit(0)) == 0
    ).otherwise((F.coalesce("visible_country_count", F.lit(0)) == 1)
                & F.equal_null("visible_countries", "expected_country"))
    sales_right = F.when(
        F.col("expected_net_sales").isNull(), F.col("net_sales").isNull()
    ).otherwise(F.coalesce(F.abs(F.col("net_sales") - F.col("expected_net_sales")) < F.lit("0.01").cast("decimal(3,2)"),
                           F.lit(False)))
    return joined.select(
        "UserPrincipalName", "expected_country", "visible_country_count", "visible_countries",
        "expected_net_sales", "net_sales", (visible_right & sales_right).alias("passed"),
    )
