"""Clickstream staging and per-customer metrics.

``customer_metrics`` (variant A) is two aggregates over the same staged rows:

* distinct orders: (customer, order_id) pairs de-duplicated map-side and shuffled
  as 16-byte keys, then counted per customer. The pairs hash on both columns, so a
  customer holding a large share of the rows is spread over many tasks.
* everything else in one aggregate per customer: money sums, the exact rounded
  mean and both "most common" values. Browser and os come from fixed rule tables,
  so "most common" is six counts per column and an argmax (ties go to the smallest
  value): fixed-width buffers in a code-generated hash aggregate, where ``mode``
  would need an object aggregate. Partial aggregation collapses each task's rows
  to one row per customer before anything is shuffled.

The two results (one row per customer each) are joined on the customer key. This
replaces the source model's three scans, two windows and two joins; compared with
one aggregate holding ``count(DISTINCT ...)``, it avoids shipping every row's
partial sums and counts through the (customer, order) exchange.

``customer_metrics_windowed`` is the literal "count per (customer, value) ->
row_number -> keep 1 -> join" form, kept as an operator in its own right; its
windows run over the pre-aggregated counts, so each window partition holds at
most six rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.functions.aggregates import most_common
from sparkwright.functions.decimals import MONEY, money_sum, rounded_mean
from sparkwright.functions.useragent import BROWSER_VALUES, OS_VALUES, parse_browser, parse_os

STAGED_COLUMNS = ("order_id", "customer_id", "order_date", "subtotal", "tax", "click_id",
                  "session_duration_secs")


def stage(df: DataFrame, variant: str = "A") -> DataFrame:
    """Raw clickstream -> staged rows with ``browser`` and ``os`` parsed from the agent.

    Variant A keeps every raw column but the agent. Variant B keeps the columns its
    metrics need and adds ``spend = subtotal + tax`` (NULL when either is NULL).
    """
    ua = F.col("user_agent")
    if variant.upper() == "A":
        return df.select(*STAGED_COLUMNS,
                         parse_browser(ua, "A").alias("browser"),
                         parse_os(ua, "A").alias("os"))
    return df.select("customer_id", "order_id",
                     (F.col("subtotal") + F.col("tax")).alias("spend"),
                     "session_duration_secs",
                     parse_browser(ua, "B").alias("browser"),
                     parse_os(ua, "B").alias("os"))


def _customer_key() -> tuple[Column, Column]:
    # (coalesce(customer, 0), customer IS NULL) groups exactly like customer_id, NULL
    # customer included, and is a plain equi-join key: both aggregates below come
    # out hash-partitioned on it, so joining them needs no further exchange.
    return (F.coalesce(F.col("customer_id"), F.lit(0)).alias("_ck"),
            F.col("customer_id").isNull().alias("_cn"))


def customer_metrics(staged: DataFrame, variant: str = "A", observed: DataFrame | None = None) -> DataFrame:
    """One row per customer. ``observed``: the same rows with metrics attached, for the one branch that reads all of them.

    Variant A: distinct order count, subtotal / tax / spend sums, mean session,
    most common browser and os (ties -> alphabetically first); the NULL customer is
    kept with NULL modes (it never joins to its mode rows in the source model).
    Variant B (input from ``stage(df, "B")``): order count (not distinct), spend
    sum, mean session and modes; the NULL customer is dropped, as an inner join on
    the key drops it.
    """
    mean_session = rounded_mean("session_duration_secs", 0, 2).alias("avg_session_duration_secs")
    if variant.upper() == "A":
        ck, cn = _customer_key()
        orders = (staged.select(ck, cn, "order_id").distinct()
                  .groupBy("_ck", "_cn").agg(F.count("order_id").alias("total_orders")))
        known = ~F.col("_cn")
        rest = (staged if observed is None else observed).groupBy(ck, cn).agg(
            money_sum("subtotal").alias("total_subtotal"),
            money_sum("tax").alias("total_tax"),
            money_sum(F.col("subtotal") + F.col("tax")).alias("total_spend"),
            mean_session,
            F.when(known, most_common("browser", BROWSER_VALUES)).alias("most_common_browser"),
            F.when(known, most_common("os", OS_VALUES)).alias("most_common_os"),
        )
        return orders.join(rest, ["_ck", "_cn"]).select(
            F.when(~F.col("_cn"), F.col("_ck")).alias("customer_id"),
            "total_orders", "total_subtotal", "total_tax", "total_spend",
            "avg_session_duration_secs", "most_common_browser", "most_common_os")
    return ((staged if observed is None else observed).filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id").agg(
                F.count("order_id").alias("total_orders"),
                money_sum("spend").alias("total_spend"),
                mean_session,
                most_common("browser", BROWSER_VALUES).alias("most_common_browser"),
                most_common("os", OS_VALUES).alias("most_common_os"),
            ))


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int = 1,
                    rank_col: str | None = None) -> DataFrame:
    """Rows ranked 1..n within each key group by ``order`` (ROW_NUMBER semantics).

    Catalyst plans a partial ``WindowGroupLimit`` before the shuffle, so each task
    forwards at most n rows per group and a hot group stays small after the
    exchange. (A rank over *all* rows of a group cannot be limited that way; see
    ``operators.ranking`` for that.)
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def _windowed_mode(staged: DataFrame, value: str, alias: str) -> DataFrame:
    counts = staged.groupBy("customer_id", value).agg(F.count(F.lit(1)).alias("freq"))
    best = top_n_per_group(counts, ["customer_id"], [F.col("freq").desc(), F.col(value).asc()], 1)
    return best.select("customer_id", F.col(value).alias(alias))


def customer_metrics_windowed(staged: DataFrame) -> DataFrame:
    """Variant A metrics in the count -> ROW_NUMBER -> LEFT JOIN form."""
    spend = staged.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        money_sum("subtotal").alias("total_subtotal"),
        money_sum("tax").alias("total_tax"),
        money_sum(F.col("subtotal") + F.col("tax")).alias("total_spend"),
        rounded_mean("session_duration_secs", 0, 2).alias("avg_session_duration_secs"),
    )
    browser = _windowed_mode(staged, "browser", "most_common_browser")
    os_mode = _windowed_mode(staged, "os", "most_common_os")
    # A USING join never matches NULL keys, so the NULL customer keeps NULL modes.
    return spend.join(browser, "customer_id", "left").join(os_mode, "customer_id", "left")

__all__ = ["stage", "customer_metrics", "customer_metrics_windowed", "top_n_per_group", "MONEY"]
