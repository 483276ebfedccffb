"""End-to-end jobs: one function per source workflow, composed from the operators.

Each job reads its inputs, writes its outputs (append, versioned merge or streaming
sinks) and returns a small summary dict of scalars for logging; rows never pass
through the driver. Scheduling, sensors and alerting are left to whatever runs
these functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.paths import decrypted_name
from sparkwright.operators import approvals as ap
from sparkwright.operators import clickstream as cs
from sparkwright.operators import feed as fd
from sparkwright.operators import quality as dq
from sparkwright.operators import sales as sl
from sparkwright.operators import tuning as tn
from sparkwright.params import ApprovalParams
from sparkwright.session import scratch_path
from sparkwright.sinks import tables as sk
from sparkwright.sources import readers as rd
from sparkwright.streaming import arrival as st


def _first_row(df: DataFrame) -> dict:
    row = df.first()
    return row.asDict() if row is not None else {}


def approve_credit_cards(spark: SparkSession, applications_csv: str, accounts_path: str,
                         params: ApprovalParams = ApprovalParams(), as_of=None) -> dict:
    """Applications CSV -> tiered approval -> summary -> partial-update merge into accounts."""
    # The CSV is parsed once; everything else reads what was landed.
    landed = scratch_path(spark, "applications")
    stats = ap.land_applications(rd.read_applications(spark, applications_csv), landed)   # fails on an empty file
    applications = spark.read.parquet(landed)
    portfolio = ap.approve(applications, params)
    summary = _first_row(ap.approval_summary(portfolio))
    tiers = {r["income_tier"]: r["applications"] for r in ap.branches(applications, params).collect()}
    stamp = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    version = sk.merge_table(spark, accounts_path, portfolio.select(*ap.PORTFOLIO_COLUMNS), ["application_id"],
                             update_columns=["credit_limit"], set_on_match={"last_updated": stamp},
                             insert_values={"last_updated": F.lit(None).cast("timestamp_ntz")})
    return {"load": stats, "branches": tiers, "summary": summary, "accounts_version": version}


def build_customer_mart(spark: SparkSession, raw_parquet: str, raw_table: str, mart_path: str) -> dict:
    """Raw clickstream -> raw table append -> staged -> metrics mart (keyed merge) -> 22 checks."""
    raw = rd.read_clickstream(spark, raw_parquet)
    rows_loaded = sk.write_reconciled(raw, raw_table)
    staged = cs.stage(rd.read_clickstream(spark, raw_table), "A")
    mart = cs.customer_metrics(staged, "A")
    version = sk.merge_table(spark, mart_path, mart, ["customer_id"])
    report = dq.dq_report(staged, "stg_clickstream", dq.STAGING_CHECKS).unionByName(
        dq.dq_report(sk.read_table(spark, mart_path), "fct_customer_metrics", dq.MART_CHECKS))
    failing = {f"{r.table_name}.{r.column_name}.{r.test_name}": r.violations
               for r in report.filter(F.col("violations") > 0).collect()}
    return {"rows_loaded": rows_loaded, "mart_version": version, "failing_checks": failing}


def insert_customer_metrics(spark: SparkSession, raw_parquet: str, raw_table: str, metrics_path: str) -> dict:
    """Variant B: raw append, then per-customer metrics appended (a re-run appends again)."""
    rows_loaded = sk.write_reconciled(rd.read_clickstream(spark, raw_parquet), raw_table)
    metrics = cs.customer_metrics(cs.stage(rd.read_clickstream(spark, raw_table), "B"), "B")
    return {"rows_loaded": rows_loaded, "metrics_rows": sk.append_table(metrics, metrics_path)}


def sales_reports(sales: DataFrame, dimensions=("by_store", "by_product", "by_day_of_week")) -> dict:
    """Non-empty check, then one lazy report per dimension (an unknown name raises)."""
    rd.require_non_empty(sales, "Source table is empty!")
    return sl.report_fan_out(sales, list(dimensions))


def ingest_feed_file(spark: SparkSession, feed_csv: str, source_key: str, landing_path: str,
                     audit_path: str, staging_path: str, as_of=None, types: dict | None = None) -> dict:
    """Feed CSV -> lineage -> landing append -> date repair of that file -> audit row."""
    clock = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    feed = rd.read_feed(spark, feed_csv, types=types)
    landed = rd.with_lineage(feed, source_key, as_of).withColumn("_ingested_at", clock)
    rows = sk.write_reconciled(landed, landing_path, partition_by=["_source_file"])
    fixes = fd.repair_landing(spark, landing_path, decrypted_name(source_key), staging_path)
    audit = fd.audit_row(spark, source_key, rows, fixes, as_of).withColumn("logged_at", clock)
    sk.write_reconciled(audit, audit_path)
    return {"rows_loaded": rows, "date_fixes_applied": fixes}


def process_vendor_drops(spark: SparkSession, landing: str, types: dict[str, str], work_path: str,
                         archive_dir: str | None = None, schema_version: str | None = None, by: str = "file",
                         max_files_per_batch: int | None = 1000) -> DataFrame:
    """Count the records of every drop that newly arrived below ``landing`` (once), archive all processed
    files, and return the per-drop totals so far.

    A drop is a plain file, or (``by="directory"``) a directory of part files that is complete when renamed to
    ``<name>.complete``. A backlog is processed in bounded micro-batches; a drop whose parts fall into several is summed by
    ``drop_totals``. Payloads and the stream's checkpoint are kept below ``work_path``.
    """
    payloads = f"{work_path}/payloads"

    def on_batch(batch, batch_id):
        st.write_batch(st.drop_payload(st.batch_rows(batch, types, by), schema_version, by), payloads, batch_id)

    st.archived_run(spark, landing, on_batch, f"{work_path}/checkpoint", by, max_files_per_batch, archive_dir)
    return st.drop_totals(spark.read.parquet(payloads))


def train_and_register(spark: SparkSession, documents: DataFrame, labels: DataFrame, registry_path: str,
                       rates=tn.LEARNING_RATES, as_of=None) -> dict:
    """Features (checked, written once) -> one model per learning rate -> best -> registry row."""
    features = tn.write_features(tn.prepare_features(documents, labels), registry_path)
    dq.assert_clean(tn.feature_checks(features))
    profile = _first_row(tn.feature_profile(features))
    weights, scores = tn.tune_learning_rate(features, rates)
    best = tn.best_candidate(scores)
    tn.register(weights, best, registry_path, as_of=as_of)
    return {"features": profile, "scores": [r.asDict() for r in scores.collect()], "best": _first_row(best)}
