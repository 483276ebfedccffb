"""End-to-end jobs on the sf0.001 tables."""

import os

import pytest
from pyspark.sql import functions as F

from sparkwright import jobs
from sparkwright.sinks import tables as sk
from sparkwright.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_approve_credit_cards_twice(spark, tmp_dir):
    csv = f"{tmp_dir}/apps"
    fx.applications(spark, SF_SMALL).write.option("header", True).csv(csv)
    accounts = f"{tmp_dir}/accounts"
    first = jobs.approve_credit_cards(spark, csv, accounts, as_of="2026-01-01 05:00:00")
    n = fx.table(spark, SF_SMALL, "customer").count()
    assert first["load"]["applications"] == n and first["summary"]["total_accounts"] == n
    assert sum(first["branches"].values()) == n
    again = jobs.approve_credit_cards(spark, csv, accounts, as_of="2026-01-02 05:00:00")
    table = sk.read_table(spark, accounts)
    assert table.count() == n and again["accounts_version"].endswith("v=000002")
    assert table.filter(F.col("last_updated").isNull()).count() == 0


def test_build_customer_mart(spark, tmp_dir):
    raw = f"{tmp_dir}/raw.parquet"
    fx.clickstream(spark, SF_SMALL).write.parquet(raw)
    out = jobs.build_customer_mart(spark, raw, f"{tmp_dir}/raw_table", f"{tmp_dir}/mart")
    assert out["rows_loaded"] == fx.table(spark, SF_SMALL, "orders").count()
    # the fixture carries NULL customers: the customer_id checks report them
    assert out["failing_checks"]["stg_clickstream.customer_id.not_null"] > 0
    assert "fct_customer_metrics.customer_id.unique" not in out["failing_checks"]
    again = jobs.insert_customer_metrics(spark, raw, f"{tmp_dir}/raw_b", f"{tmp_dir}/metrics_b")
    assert again["metrics_rows"] > 0


def test_sales_reports_and_feed_ingest(spark, tmp_dir):
    reports = jobs.sales_reports(fx.sales(spark, SF_SMALL))
    assert reports["by_product"].count() == 5 and reports["by_day_of_week"].count() == 7
    with pytest.raises(ValueError):
        jobs.sales_reports(fx.sales(spark, SF_SMALL).limit(0))
    feed_csv = f"{tmp_dir}/daily.csv"
    fx.landing(spark, SF_SMALL).write.option("header", True).csv(feed_csv)
    out = jobs.ingest_feed_file(spark, feed_csv, "feeds/daily.csv.pgp", f"{tmp_dir}/landing", f"{tmp_dir}/audit",
                                f"{tmp_dir}/stage", as_of="2026-01-01 05:00:00", types={"o_orderkey": "bigint"})
    n = fx.table(spark, SF_SMALL, "orders").count()
    assert out["rows_loaded"] == n and 0 < out["date_fixes_applied"] < n
    audit = spark.read.parquet(f"{tmp_dir}/audit").first()
    assert (audit.source_file, audit.rows_loaded, audit.status) == ("feeds/daily.csv.pgp", n, "SUCCESS")


def test_vendor_drops_and_training(spark, tmp_dir):
    events = fx.table(spark, SF_SMALL, "events").drop("props")
    events.write.option("header", True).csv(f"{tmp_dir}/in/vendor_data.csv.complete")
    totals = jobs.process_vendor_drops(
        spark, f"{tmp_dir}/in", {"event_id": "bigint", "ts": "string", "user_id": "bigint", "event_type": "string", "value": "double"},
        f"{tmp_dir}/work", schema_version="v3", by="directory").collect()
    assert [(r.file, r.record_count) for r in totals] == [("vendor_data.csv", events.count())]
    docs, labels = fx.training_events(spark, SF_SMALL)
    out = jobs.train_and_register(spark, docs, labels, f"{tmp_dir}/registry", as_of="2026-01-01 05:00:00")
    assert len(out["scores"]) == 3 and out["best"]["learning_rate"] in (0.01, 0.05, 0.1)
    assert os.path.isdir(f"{tmp_dir}/registry/models")
