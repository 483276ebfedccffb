"""Sales reports, feed repair and data-quality operators."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparkwright.operators import feed as fd
from sparkwright.operators import quality as dq
from sparkwright.operators import sales as sl
from sparkwright.sources import fixtures as fx
from sparkwright.sources.readers import with_lineage
from tests.conftest import SF_SMALL

SALES = "customerID bigint, product string, dateTime timestamp_ntz, quantity int, unitPrice decimal(10,2)"


def sales(spark, rows):
    return spark.createDataFrame(rows, SALES)


def test_top_customers_tie_break_and_plan(spark):
    t = dt.datetime(2026, 1, 5)
    rows = [(c, "p", t, 1, Decimal("10.00")) for c in range(10, 0, -1)]
    top = sl.top_customers_by_revenue(sales(spark, rows), 5)
    assert [r.customerID for r in top.collect()] == [1, 2, 3, 4, 5]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_top_products_and_day_of_week(spark):
    mon, tue = dt.datetime(2026, 1, 5), dt.datetime(2026, 1, 6)
    df = sales(spark, [(1, "bun", mon, 3, Decimal("1.10")), (2, "bun", tue, 1, Decimal("1.10")),
                       (1, "pie", mon, 2, Decimal("4.00")), (3, "pie", mon, 1, Decimal("0.01"))])
    prods = [(r.product, r.units_sold, r.revenue) for r in sl.top_products_by_units(df).collect()]
    assert prods == [("bun", 4, Decimal("4.40")), ("pie", 3, Decimal("8.01"))]
    days = [(r.day, r.transactions, r.avg_sale) for r in sl.sales_by_day_of_week(df).collect()]
    # Monday: (3.30 + 8.00 + 0.01) / 3 = 3.77 (HALF_UP of 3.77)
    assert days == [("Monday", 3, Decimal("3.77")), ("Tuesday", 1, Decimal("1.10"))]


def test_empty_source_fails_and_unknown_dimension(spark):
    with pytest.raises(Exception, match="empty"):
        sl.table_row_count(sales(spark, [])).collect()
    with pytest.raises(ValueError):
        sl.report(sales(spark, []), "by_planet")
    assert set(sl.report_fan_out(sales(spark, []), ["by_store", "by_product", "by_day_of_week"])) == \
        {"by_store", "by_product", "by_day_of_week"}


FEED = "o_orderkey bigint, order_date string, ship_date string"


def feed(spark, rows):
    return spark.createDataFrame(rows, FEED)


def test_row_mode_nulls_iso_companion_column_mode_keeps_it(spark):
    df = feed(spark, [(1, "03/15/2024", "2024-03-18"), (2, "2024-03-15", "2024-03-18"),
                      (3, None, "03/18/2024"), (4, "not-a-date", "2024-03-18")])
    row = {r.o_orderkey: (r.order_date, r.ship_date) for r in fd.normalize_dates(df).collect()}
    assert row == {1: ("2024-03-15", None), 2: ("2024-03-15", "2024-03-18"),
                   3: (None, "2024-03-18"), 4: (None, None)}
    col = {r.o_orderkey: (r.order_date, r.ship_date) for r in fd.normalize_dates(df, mode="column").collect()}
    assert col == {1: ("2024-03-15", "2024-03-18"), 2: ("2024-03-15", "2024-03-18"),
                   3: (None, "2024-03-18"), 4: (None, "2024-03-18")}
    assert fd.bad_date_count(df).first().bad_dates == 3


def test_repair_is_scoped_to_the_source_file(spark):
    a = with_lineage(feed(spark, [(1, "03/15/2024", "2024-03-18")]), "in/a.csv.pgp", "2026-01-01 00:00:00")
    b = with_lineage(feed(spark, [(2, "03/15/2024", "2024-03-18")]), "in/b.csv", "2026-01-01 00:00:00")
    both = a.unionByName(b)
    assert {r._source_file for r in both.collect()} == {"a.csv", "b.csv"}
    out = {r.o_orderkey: r.order_date for r in fd.normalize_dates(both, source_file="a.csv").collect()}
    assert out == {1: "2024-03-15", 2: "03/15/2024"}
    audit = fd.audit_summary(both, "in/a.csv.pgp", "2026-01-01 00:00:00", source_file="a.csv").first()
    assert (audit.source_file, audit.rows_loaded, audit.date_fixes_applied, audit.status) == \
        ("in/a.csv.pgp", 2, 1, "SUCCESS")


def test_fixture_landing_counts(spark):
    landing = fx.landing(spark, "/root/testdata/sf0.01")
    assert fd.bad_date_count(landing).first().bad_dates == 10_500


def test_dq_report_clean_and_dirty(spark):
    from sparkwright.operators.clickstream import customer_metrics, stage
    staged = stage(fx.clickstream(spark, SF_SMALL))
    rep = {(r.table_name, r.column_name, r.test_name): r.violations
           for r in dq.dq_report(staged, "stg", dq.STAGING_CHECKS).unionByName(
               dq.dq_report(customer_metrics(staged), "mart", dq.MART_CHECKS)).collect()}
    assert len(rep) == 22
    nulls = staged.filter(F.col("customer_id").isNull()).count()
    assert rep[("stg", "customer_id", "not_null")] == nulls > 0
    assert rep[("mart", "customer_id", "unique")] == 0
    assert rep[("mart", "customer_id", "not_null")] == 1
    assert rep[("stg", "browser", "accepted_values")] == 0
    dirty = spark.createDataFrame([("Netscape",), ("Netscape",), ("Lynx",), ("Chrome",), (None,)], "browser string")
    r = dq.accepted_values(dirty, "browser", ["Chrome"], "t").first()
    assert r.violations == 2
    with pytest.raises(AssertionError):
        dq.assert_clean(dq.not_null(dirty, "browser", "t"))
    dup = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (None,), (None,)], "k int")
    assert dq.unique(dup, "k").first().violations == 2


def test_repair_landing_touches_earlier_loads_of_the_same_file_only(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    for key, rows in (("in/a.csv.pgp", [(1, "03/15/2024", "2024-03-18")]),
                      ("in/b.csv", [(2, "03/15/2024", "2024-03-18")]),
                      ("in/a.csv.pgp", [(3, "2024-01-01", "01/04/2024")])):
        (with_lineage(feed(spark, rows), key, "2026-01-01 00:00:00")
         .write.mode("append").partitionBy("_source_file").parquet(landing))
    assert fd.repair_landing(spark, landing, "a.csv", f"{tmp_dir}/stage1") == 2
    got = {r.o_orderkey: (r.order_date, r.ship_date) for r in spark.read.parquet(landing).collect()}
    assert got == {1: ("2024-03-15", None), 2: ("03/15/2024", "2024-03-18"), 3: (None, "2024-01-04")}
    # Column mode leaves repaired rows alone (only the NULLs still count as bad)...
    assert fd.repair_landing(spark, landing, "a.csv", f"{tmp_dir}/stage2", mode="column") == 2
    assert {r.o_orderkey: (r.order_date, r.ship_date) for r in spark.read.parquet(landing).collect()} == got
    # ...row mode, like the source UPDATE, re-parses both dates of a row with a NULL.
    assert fd.repair_landing(spark, landing, "a.csv", f"{tmp_dir}/stage3") == 2
    got = {r.o_orderkey: (r.order_date, r.ship_date) for r in spark.read.parquet(landing).collect()}
    assert got == {1: (None, None), 2: ("03/15/2024", "2024-03-18"), 3: (None, None)}
