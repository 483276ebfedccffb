"""Reports, checks, metrics and catalog tables that read their rows once or without a shuffle."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from sparkwright.operators import clickstream as cs
from sparkwright.operators import metrics_state as ms
from sparkwright.operators import quality as dq
from sparkwright.operators import sales as sl
from sparkwright.sources import catalog_tables as ct
from sparkwright.sources import fixtures as fx
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_reports_read_the_sales_once(spark, tmp_dir):
    fx.sales(spark, SF_SMALL).write.parquet(f"{tmp_dir}/sales")
    sales = spark.read.parquet(f"{tmp_dir}/sales")
    dimensions = ["by_store", "by_product", "by_day_of_week", "by_customer"]
    got = sl.reports_in_one_pass(sales, [*dimensions, "by_store"])
    assert len(re.findall(r"FileScan parquet", plan_of(got))) == 1
    for d, report in sl.report_fan_out(sales, dimensions).items():
        label, n, amount = report.columns
        expected = report.select(F.lit(d), F.col(label).cast("string"), n, F.col(amount).cast("decimal(38,2)"))
        assert rows_of(got.where(F.col("dimension") == d)) == rows_of(expected)
    assert rows_of(sl.reports_in_one_pass(sales, ["by_product"])) == rows_of(got.where("dimension = 'by_product'"))
    with pytest.raises(ValueError, match="unknown"):
        sl.reports_in_one_pass(sales, ["by_moon"])


def test_reports_with_null_keys(spark):
    sales = spark.createDataFrame([(None, None, None, 1, 1), (None, "p", None, 2, 1), (1, None, None, 2, 1)],
                                  "customerID long, product string, dateTime timestamp, quantity int, unitPrice int")
    sales = sales.withColumn("unitPrice", F.col("unitPrice").cast("decimal(10,2)"))
    got = {(r.dimension, r.label): (r.n, float(r.amount)) for r in sl.reports_in_one_pass(sales, ["by_store", "by_product"]).collect()}
    assert got == {("by_store", None): (2, 3.0), ("by_store", "1"): (1, 2.0), ("by_product", None): (3, 3.0), ("by_product", "p"): (2, 2.0)}


def checks_of(report):
    return sorted((r.table_name, r.column_name, r.test_name, r.violations) for r in report.collect())


def test_checks_measured_on_the_write(spark, tmp_dir):
    staged = cs.stage(fx.clickstream(spark, SF_SMALL), "A")
    seen = dq.ObservedChecks(staged, "stg", dq.STAGING_CHECKS)
    cs.customer_metrics(staged, observed=seen.rows).write.parquet(f"{tmp_dir}/mart")
    report = seen.report()
    assert "FileScan" not in plan_of(report)  # nothing is read again
    assert checks_of(report) == checks_of(dq.dq_report(staged, "stg", dq.STAGING_CHECKS))


def test_broken_checks_and_a_wrong_count_are_made_again(spark, tmp_dir):
    rows = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "v string")
    checks = [dq.Check("v", "not_null"), dq.Check("v", "accepted_values", ("a",)), dq.Check("v", "unique")]
    expected = [("t", "v", "accepted_values", 2), ("t", "v", "not_null", 1), ("t", "v", "unique", 1)]
    seen = dq.ObservedChecks(rows, "t", checks)
    seen.rows.write.parquet(f"{tmp_dir}/t")
    assert checks_of(seen.report(spark.read.parquet(f"{tmp_dir}/t"))) == expected
    assert checks_of(seen.report(rows=4)) == expected


def test_merged_loads_equal_one_recomputation(spark, tmp_dir):
    staged = cs.stage(fx.clickstream(spark, SF_SMALL), "A").cache()
    parts = [staged.where(F.pmod(F.hash("click_id"), F.lit(3)) == k) for k in range(3)]
    overlap = parts[0].limit(20)  # order ids of the first load come again with the third
    state = ms.load_state(parts[0]).write(f"{tmp_dir}/0")
    for k in (1, 2):
        state = ms.merge_states(state, ms.load_state(parts[k] if k == 1 else parts[k].unionByName(overlap))).write(f"{tmp_dir}/{k}")
    assert rows_of(ms.metrics(state)) == rows_of(cs.customer_metrics(staged.unionByName(overlap)))
    none = ms.load_state(staged.limit(0))
    assert rows_of(ms.metrics(ms.merge_states(state, none))) == rows_of(ms.metrics(state)) and ms.metrics(none).count() == 0


def test_state_of_awkward_rows(spark):
    rows = spark.sql("""SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id, CAST(subtotal AS DECIMAL(12,2)) AS subtotal,
          CAST(tax AS DECIMAL(12,2)) AS tax, CAST(secs AS INT) AS session_duration_secs, browser, os FROM VALUES (NULL, 0, NULL, NULL, NULL, 'Edge', 'iOS'),
          (-5, NULL, 1, NULL, -3, 'Edge', 'iOS'), (-5, NULL, 1, 1, 4, 'Other', 'iOS'), (40000, 0, 1, 1, 5, 'Other', 'Linux'),
          (1, 7, 1, 1, -1, 'Chrome', 'macOS'), (2, 7, 1, 1, -2, 'Edge', 'macOS') AS t(order_id, customer_id, subtotal, tax, secs, browser, os)""")
    assert rows_of(ms.metrics(ms.load_state(rows))) == rows_of(cs.customer_metrics(rows))


def test_bucketed_tables_need_no_exchange_by_customer(spark):
    name = f"clicks_{uuid.uuid4().hex[:8]}"
    click = fx.clickstream(spark, SF_SMALL)
    try:
        ct.save_bucketed(click, name, "customer_id", 4)
        got = cs.customer_metrics_windowed(cs.stage(ct.read_clickstream_table(spark, name), "A"))
        assert "Exchange" not in plan_of(got), plan_of(got)
        assert rows_of(got) == rows_of(cs.customer_metrics(cs.stage(click, "A")))
        b = cs.customer_metrics(cs.stage(ct.read_clickstream_table(spark, name), "B"), "B")
        assert "Exchange" not in plan_of(b) and rows_of(b) == rows_of(cs.customer_metrics(cs.stage(click, "B"), "B"))
        with pytest.raises(Exception, match="nothing"):
            ct.read_clickstream_table(spark, name, {"nothing": "int"})
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
