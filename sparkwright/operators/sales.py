"""Sales reports: top customers by revenue, top products by units, day of week.

Top-k reports are ``orderBy(...).limit(k)``, planned as ``TakeOrderedAndProject``:
each task keeps its own k best rows and only those reach the final merge. The key
is added as a tie-break so the k rows are deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.decimals import TOTAL, money_sum, rounded_mean
from sparkwright.operators.clickstream import top_n_per_group


def line_revenue():
    return F.col("quantity") * F.col("unitPrice")


def top_customers_by_revenue(df: DataFrame, n: int = 5) -> DataFrame:
    return (df.groupBy("customerID")
            .agg(F.count(F.lit(1)).alias("transactions"), money_sum(line_revenue()).alias("revenue"))
            .orderBy(F.col("revenue").desc(), F.col("customerID").asc())
            .limit(n))


def top_products_by_units(df: DataFrame, n: int = 5) -> DataFrame:
    return (df.groupBy("product")
            .agg(F.sum("quantity").cast("bigint").alias("units_sold"), money_sum(line_revenue()).alias("revenue"))
            .orderBy(F.col("units_sold").desc(), F.col("product").asc())
            .limit(n))


def sales_by_day_of_week(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.date_format("dateTime", "EEEE").alias("day"))
            .agg(F.count(F.lit(1)).alias("transactions"),
                 rounded_mean("quantity * unitPrice", 2, 2).alias("avg_sale"))
            .orderBy(F.col("transactions").desc(), F.col("day").asc()))


def table_row_count(df: DataFrame) -> DataFrame:
    """One row with the row count; the job fails when the table is empty."""
    n = F.count(F.lit(1))
    return df.agg(F.when(n > 0, n).otherwise(F.raise_error(F.lit("Source table is empty!")).cast("bigint"))
                  .alias("row_count"))


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "by_store": top_customers_by_revenue,
    "by_customer": top_customers_by_revenue,
    "by_product": top_products_by_units,
    "by_day_of_week": sales_by_day_of_week,
}


def report(df: DataFrame, dimension: str) -> DataFrame:
    """Report for one dimension name; an unknown name is an error."""
    try:
        return REPORTS[dimension](df)
    except KeyError:
        raise ValueError(f"unknown report dimension {dimension!r}; known: {sorted(REPORTS)}") from None


def report_fan_out(df: DataFrame, dimensions: list[str]) -> dict[str, DataFrame]:
    """One lazy report per dimension, all over the same input plan."""
    return {d: report(df, d) for d in dimensions}


# Per dimension: the column that groups it, the order of its rows, the columns that it reports as n and amount, and its rows (None: all).
_ONE_PASS = {
    "by_store": ("customerID", "revenue", "transactions", "revenue", 5),
    "by_customer": ("customerID", "revenue", "transactions", "revenue", 5),
    "by_product": ("product", "units_sold", "units_sold", "revenue", 5),
    "by_day_of_week": ("day", "transactions", "transactions", "avg_sale", None),
}
_WEEK = 7


def reports_in_one_pass(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """All reports as (dimension, label, n, amount), by one aggregate over grouping sets: ``df`` is read once.

    Partial aggregation collapses a task's rows to one for each value of each set, and the best rows of a set are chosen
    in the tasks before they meet. A dimension asked for twice is reported once; an unknown one is an error.
    """
    if unknown := [d for d in dimensions if d not in _ONE_PASS]:
        raise ValueError(f"unknown report dimension {unknown[0]!r}; known: {sorted(_ONE_PASS)}")
    dimensions = list(dict.fromkeys(dimensions))
    keys = list(dict.fromkeys(_ONE_PASS[d][0] for d in dimensions))
    rows = df.select("customerID", "product", F.date_format("dateTime", "EEEE").alias("day"), "quantity", "unitPrice")
    sets = rows.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
        # A bit is set for each key that isn't grouped by.
        F.grouping_id(*keys).cast("int").alias("_set"), F.count(F.lit(1)).alias("transactions"), F.sum("quantity").cast("bigint").alias("units_sold"),
        money_sum(line_revenue()).alias("revenue"), rounded_mean("quantity * unitPrice", 2, 2).cast(TOTAL).alias("avg_sale"))
    own_set = {k: 2 ** len(keys) - 1 - 2 ** (len(keys) - 1 - i) for i, k in enumerate(keys)}

    def by_set(value) -> Column:
        out = F.lit(None)
        for d in dimensions:
            out = F.when(F.col("_set") == own_set[_ONE_PASS[d][0]], value(d)).otherwise(out)
        return out

    ordered = sets.withColumn("_by", by_set(lambda d: F.col(_ONE_PASS[d][1]).cast(TOTAL)))
    best = top_n_per_group(ordered, ["_set"], [F.desc("_by"), *[F.asc(k) for k in keys]], _WEEK, rank_col="_rank")
    out = None
    for d in dimensions:
        key, _, n, amount, most = _ONE_PASS[d]
        own = F.struct(F.lit(d).alias("dimension"), F.col(key).cast("string").alias("label"), F.col(n).alias("n"), F.col(amount).alias("amount"))
        out_of = (F.col("_set") == own_set[key]) & (F.col("_rank") <= (most or _WEEK))
        out = [*(out or []), F.when(out_of, own)]
    return best.select(F.explode(F.filter(F.array(*out), lambda r: r.isNotNull())).alias("r")).select("r.*")
