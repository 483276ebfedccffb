"""Clickstream metrics: semantics on hand-made rows, plan shape, and the skew-safe rank."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkwright.operators import clickstream as cs
from sparkwright.operators.ranking import rank_within
from sparkwright.sources import fixtures as fx
from tests.conftest import SF_SMALL

RAW = ("order_id bigint, customer_id bigint, order_date timestamp_ntz, subtotal decimal(12,2), "
       "tax decimal(12,2), click_id string, user_agent string, session_duration_secs int")
CHROME = "Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36"
FIREFOX = "Mozilla/5.0 (X11; Linux x86_64) Firefox/121.0"
SAFARI = "Mozilla/5.0 (Macintosh; Intel Mac OS X) Version/17 Safari/605"
D = dt.datetime(2026, 1, 5)


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def row(oid, cust, ua, sub="10.00", tax="1.00", secs=100, day=D):
    return (oid, cust, day, Decimal(sub), None if tax is None else Decimal(tax), f"clk-{oid}", ua, secs)


def test_metrics_distinct_orders_ties_and_null_customer(spark):
    df = raw(spark, [
        row(1, 7, CHROME), row(1, 7, FIREFOX), row(2, 7, FIREFOX, secs=101), row(3, 7, CHROME, secs=102),
        row(4, None, SAFARI), row(5, None, SAFARI, tax=None),
    ])
    got = {r.customer_id: r for r in cs.customer_metrics(cs.stage(df)).collect()}
    c7 = got[7]
    assert c7.total_orders == 3                        # order 1 appears twice
    assert c7.most_common_browser == "Chrome"          # 2 Chrome vs 2 Firefox: alphabetical
    assert c7.avg_session_duration_secs == Decimal("100.75")
    assert c7.total_spend == Decimal("44.00")
    nul = got[None]
    assert nul.most_common_browser is None and nul.most_common_os is None
    assert nul.total_tax == Decimal("1.00") and nul.total_spend == Decimal("11.00")  # NULL tax skips the row


def test_variant_b_counts_rows_and_drops_null_customer(spark):
    df = raw(spark, [row(1, 7, CHROME), row(1, 7, CHROME), row(9, None, CHROME)])
    got = cs.customer_metrics(cs.stage(df, "B"), "B").collect()
    assert [(r.customer_id, r.total_orders) for r in got] == [(7, 2)]


def test_single_pass_equals_windowed_form(spark):
    staged = cs.stage(fx.clickstream(spark, SF_SMALL))
    a = cs.customer_metrics(staged)
    b = cs.customer_metrics_windowed(staged).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_has_no_window_and_prunes_columns(spark):
    plan = _plan(cs.customer_metrics(cs.stage(fx.clickstream(spark, SF_SMALL))))
    assert plan.count("Join") <= 1                  # only the per-customer join of two aggregates
    assert "Window [" not in plan and "WindowGroupLimit" not in plan
    # Column pruning reaches the scan: only the three columns the metrics need are read.
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_rank_matches_window_with_a_hot_key(spark):
    # Key 0 holds half of all rows; ties on the order column are frequent.
    df = spark.range(0, 20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        (F.col("id") % 1_500).alias("o"),
        F.col("id"),
    ).union(spark.createDataFrame([(None, 5, -1), (3, None, -2), (None, None, -3)], "k long, o long, id long"))
    w = Window.partitionBy("k").orderBy(F.col("o").desc_nulls_first())
    want = df.withColumn("r", F.rank().over(w).cast("bigint"))
    for rows in (df, df.repartition(3)):
        got = rank_within(rows, "k", "o", out="r")
        assert got.count() == df.count()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_top_n_per_group(spark):
    df = spark.createDataFrame([(1, 5), (1, 9), (1, 7), (2, 1)], "g int, v int")
    got = sorted(cs.top_n_per_group(df, ["g"], [F.col("v").desc()], 2).collect())
    assert [(r.g, r.v) for r in got] == [(1, 7), (1, 9), (2, 1)]


def test_load_cutoff_is_pushed_to_the_scan(spark):
    click = fx.clickstream(spark, SF_SMALL)
    df = cs.customer_metrics(cs.stage(click.filter(F.col("order_date") < F.lit("2000-01-01").cast("timestamp_ntz"))))
    scans = [line for line in _plan(df).splitlines() if "FileScan parquet" in line]
    assert scans and all("PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in s for s in scans)


def test_most_common_with_labels_equals_mode(spark):
    from sparkwright.functions.aggregates import most_common
    rows = [(g, v) for g, vals in {1: "abba", 2: "cab", 3: "c", 4: ""}.items() for v in (vals or [None])]
    df = spark.createDataFrame(rows, "g int, v string")
    a = df.groupBy("g").agg(most_common("v", ("a", "b", "c")).alias("m"))
    b = df.groupBy("g").agg(most_common("v").alias("m"))
    assert sorted(a.collect()) == sorted(b.collect())
    assert {r.g: r.m for r in a.collect()} == {1: "a", 2: "a", 3: "c", 4: None}


def test_customer_zero_and_null_customer_stay_apart(spark):
    df = raw(spark, [row(1, 0, CHROME), row(2, 0, CHROME), row(3, None, FIREFOX)])
    got = {r.customer_id: (r.total_orders, r.most_common_browser) for r in cs.customer_metrics(cs.stage(df)).collect()}
    assert got == {0: (2, "Chrome"), None: (1, None)}
