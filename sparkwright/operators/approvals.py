"""Credit-card approval: tier routing, limits, summaries.

The two branches of the source pipeline (premium / standard lists) are one
DataFrame with a tier column here: routing is a ``CASE``, the limits are two arms
of another, and the summary and the merge are separate actions over the same
plan. No row reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sparkwright.functions.decimals import TOTAL, money_sum, rounded_mean
from sparkwright.params import PREMIUM, STANDARD, ApprovalParams

PORTFOLIO_COLUMNS = ("application_id", "customer_name", "annual_income", "card_product",
                     "credit_limit", "income_tier")


def income_tier(params: ApprovalParams = ApprovalParams()):
    """PREMIUM above the threshold, STANDARD at or below it."""
    return F.when(F.col("annual_income") > F.lit(params.threshold), F.lit(PREMIUM)).otherwise(F.lit(STANDARD))


def route(df: DataFrame, params: ApprovalParams = ApprovalParams()) -> DataFrame:
    return df.withColumn("income_tier", income_tier(params))


def route_premium(df: DataFrame, params: ApprovalParams = ApprovalParams()) -> DataFrame:
    return df.filter(F.col("annual_income") > F.lit(params.threshold))


def route_standard(df: DataFrame, params: ApprovalParams = ApprovalParams()) -> DataFrame:
    return df.filter(F.col("annual_income") <= F.lit(params.threshold))


def branches(df: DataFrame, params: ApprovalParams = ApprovalParams()) -> DataFrame:
    """Which tiers are non-empty, with their sizes (one row per present tier)."""
    return route(df, params).groupBy("income_tier").agg(F.count(F.lit(1)).alias("applications"))


def approve(df: DataFrame, params: ApprovalParams = ApprovalParams()) -> DataFrame:
    """Applications -> portfolio rows with product, limit, tier and a floor flag.

    premium limit  = round(income * premium_rate, 2)
    standard limit = round(max(income * standard_rate, floor), 2); ``floor_applied``
    when income * standard_rate is strictly below the floor.
    Limits are computed on exact decimals, halves rounded away from zero, and returned as double. At the
    default rates limits have no third decimal; at rates where they have, binary rounding may give another cent.
    """
    income = F.col("annual_income").cast("decimal(20,0)")
    premium_raw = income * F.lit(params.rate(PREMIUM))
    standard_raw = income * F.lit(params.rate(STANDARD))
    floor = F.lit(params.standard_floor).cast("decimal(20,0)")
    is_premium = F.col("annual_income") > F.lit(params.threshold)
    limit = F.when(is_premium, F.round(premium_raw, 2)).otherwise(F.round(F.greatest(standard_raw, floor), 2))
    return df.select(
        "application_id", "customer_name", "annual_income",
        F.when(is_premium, F.lit(params.premium_product)).otherwise(F.lit(params.standard_product)).alias("card_product"),
        limit.cast("double").alias("credit_limit"),
        F.when(is_premium, F.lit(PREMIUM)).otherwise(F.lit(STANDARD)).alias("income_tier"),
        (~is_premium & (standard_raw < floor)).alias("floor_applied"),
    )


def combine_portfolios(*portfolios: DataFrame | None) -> DataFrame:
    """Bag union of branch portfolios; a missing (None) branch contributes nothing."""
    present = [p for p in portfolios if p is not None]
    if not present:
        raise ValueError("at least one portfolio is needed to know the schema")
    out = present[0]
    for p in present[1:]:
        out = out.unionByName(p)
    return out


def approval_summary(portfolio: DataFrame) -> DataFrame:
    """One row: accounts, total credit volume (0 when empty), average limit (NULL when empty)."""
    limit = F.col("credit_limit").cast("decimal(18,2)")
    return portfolio.agg(
        F.count(F.lit(1)).alias("total_accounts"),
        F.coalesce(money_sum(limit), F.lit(0).cast(TOTAL)).alias("total_credit_volume"),
        rounded_mean("CAST(credit_limit AS DECIMAL(18,2))", 2, 2).alias("avg_credit_limit"),
    )


def tier_volumes(portfolio: DataFrame) -> DataFrame:
    """Per tier and product: accounts and credit volume."""
    return portfolio.groupBy("income_tier", "card_product").agg(
        F.count(F.lit(1)).alias("accounts"),
        money_sum(F.col("credit_limit").cast("decimal(18,2)")).alias("credit_volume"),
    )


def ingest_stats(applications: DataFrame) -> DataFrame:
    """Rows loaded with min and max income; an empty load is an error."""
    n = F.count(F.lit(1))
    return applications.agg(
        F.when(n > 0, n).otherwise(F.raise_error(F.lit("no applications were loaded")).cast("bigint")).alias("applications"),
        F.min("annual_income").alias("min_income"),
        F.max("annual_income").alias("max_income"),
    )


def land_applications(applications: DataFrame, path: str) -> dict:
    """Append the typed applications to ``path`` and return the load's stats.

    Row count and income range come from an Observation on the write itself (one
    pass over the input); an empty load is an error, as in the source step.
    """
    obs = Observation()
    (applications.observe(obs, F.count(F.lit(1)).alias("applications"),
                          F.min("annual_income").alias("min_income"),
                          F.max("annual_income").alias("max_income"))
     .write.mode("append").parquet(path))
    stats = dict(obs.get)
    if not stats.get("applications"):
        raise ValueError("no applications were loaded")
    return stats
