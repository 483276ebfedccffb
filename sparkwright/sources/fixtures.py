"""Input views derived from the driver tables (see FIXTURES.md §2).

Each view is a lazy projection (plus, for ``sales``, joins) of the parquet tables,
so Catalyst prunes columns and pushes filters down to the scans. The SQL oracle
defines the same views in DuckDB SQL.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.sizes import broadcast_if_small

# The user-agent strings of the clickstream fixture, selected by
# (o_orderkey * 7 + o_custkey) % 12; slot 11 is a missing agent.
FIXTURE_USER_AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 Edg/120.0.0.0",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.3 Safari/605.1.15",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.2 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chromium/119.0 Chrome/119.0 Safari/537.36",
    "Opera/9.80 (Windows NT 6.1; U; en) Presto/2.12.388 Version/12.18",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 OPR/106.0.0.0",
    "curl/8.4.0",
    "mozilla/5.0 (ipad; cpu os 16_0) applewebkit/605.1.15 version/16.0 safari/604.1",
    None,
)

# Incomes pinned for the boundary cases of the approval rules.
PINNED_INCOMES = {1: 100_000, 2: 100_001, 3: 25_000, 4: 20_000, 5: 3_000_000_000}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    slot = (key * 7 + cust) % 12
    agent = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, ua in enumerate(FIXTURE_USER_AGENTS):
        if ua is not None:
            agent = agent.when(slot == i, F.lit(ua))
    subtotal = F.col("o_totalprice").cast("decimal(12,2)")
    return o.select(
        (F.lit(100000) + cust * 8 + key % 8).cast("bigint").alias("order_id"),
        F.when(key % 97 == 0, F.lit(None).cast("bigint")).otherwise(cust).alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        subtotal.alias("subtotal"),
        (subtotal * F.lit(0.08).cast("decimal(3,2)")).cast("decimal(12,2)").alias("tax"),
        F.concat(F.lit("clk-"), F.lpad(key.cast("string"), 7, "0")).alias("click_id"),
        agent.alias("user_agent"),
        (F.lit(10) + (key * 37) % 1791).cast("int").alias("session_duration_secs"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    # A part table that measures small doesn't cost lineitem a shuffle.
    joined = li.join(broadcast_if_small(p), li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
    return joined.select(
        F.col("o_custkey").alias("customerID"),
        F.col("p_name").alias("product"),
        F.col("o_orderdate").alias("dateTime"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unitPrice"),
    )


def applications(spark: SparkSession, sf_dir: str, customers: DataFrame | None = None) -> DataFrame:
    """Applications of ``customers`` (default: the whole customer table)."""
    c = table(spark, sf_dir, "customer") if customers is None else customers
    key = F.col("c_custkey")
    income = F.floor(F.abs(F.col("c_acctbal")) * 20)
    for k, v in PINNED_INCOMES.items():
        income = F.when(key == k, F.lit(v)).otherwise(income)
    return c.select(
        F.concat(F.lit("APP-"), F.lpad(key.cast("string"), 6, "0")).alias("application_id"),
        F.when(key % 50 == 7, F.lit("")).otherwise(F.col("c_name")).alias("customer_name"),
        income.cast("bigint").alias("annual_income"),
    )


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    ship = F.date_add(day, 3)
    order_date = (F.when(key % 5 == 0, F.date_format(day, "MM/dd/yyyy"))
                  .when(key % 5 == 1, F.lit("not-a-date"))
                  .when(key % 5 == 2, F.lit(None).cast("string"))
                  .otherwise(F.date_format(day, "yyyy-MM-dd")))
    ship_date = (F.when((key % 10).isin(0, 1, 3), F.date_format(ship, "MM/dd/yyyy"))
                 .otherwise(F.date_format(ship, "yyyy-MM-dd")))
    return o.select(key.alias("o_orderkey"), order_date.alias("order_date"), ship_date.alias("ship_date"))


def training_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(documents, labels) for the feature job."""
    return table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
