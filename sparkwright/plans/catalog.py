"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the driver tables (through the fixture views) in full, so its
work grows with the scale factor. Queries that exercise a sink or a stream write
below the shared checkpoint folder and return a read of what was written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.paths import cold_path, decrypted_name
from sparkwright.functions.useragent import BROWSER_VALUES
from sparkwright.jobs import process_vendor_drops
from sparkwright.operators import approvals as ap
from sparkwright.operators import boosting as bt
from sparkwright.operators import clickstream as cs
from sparkwright.operators import feed as fd
from sparkwright.operators import metrics_state as ms
from sparkwright.operators import quality as dq
from sparkwright.operators import sales as sl
from sparkwright.operators import tuning as tn
from sparkwright.operators.ranking import order_recency_rank
from sparkwright.params import ApprovalParams
from sparkwright.session import scratch_path
from sparkwright.sinks import tables as sk
from sparkwright.sources import catalog_tables as ct
from sparkwright.sources import fixtures as fx
from sparkwright.sources import readers as rd
from sparkwright.streaming import arrival as st
from sparkwright.streaming.feed import ingest_feed

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------------- clickstream

def q_staged_clickstream(spark, sf_dir):
    return cs.stage(fx.clickstream(spark, sf_dir), "A")


def q_staged_clickstream_b(spark, sf_dir):
    return cs.stage(fx.clickstream(spark, sf_dir), "B")


def q_customer_metrics(spark, sf_dir):
    return cs.customer_metrics(cs.stage(fx.clickstream(spark, sf_dir), "A"), "A")


def q_customer_metrics_b(spark, sf_dir):
    return cs.customer_metrics(cs.stage(fx.clickstream(spark, sf_dir), "B"), "B")


def q_customer_metrics_windowed(spark, sf_dir):
    return cs.customer_metrics_windowed(cs.stage(fx.clickstream(spark, sf_dir), "A"))


BUCKETS = 8  # of the clickstream's catalog table


def q_customer_metrics_bucketed(spark, sf_dir):
    """The windowed form over a table bucketed by customer: its aggregates, windows and joins need no exchange."""
    name = f"clickstream_{uuid.uuid4().hex[:12]}"
    ct.save_bucketed(fx.clickstream(spark, sf_dir), name, "customer_id", BUCKETS)
    return cs.customer_metrics_windowed(cs.stage(ct.read_clickstream_table(spark, name), "A"))


def q_customer_metrics_merged(spark, sf_dir):
    """Two loads' states merged into the metrics of both; an order id that comes in both counts once."""
    path = scratch_path(spark, "metrics_state")
    click = cs.stage(fx.clickstream(spark, sf_dir), "A")
    early = F.col("order_date") < F.lit(EARLIER_LOAD_BEFORE).cast("timestamp_ntz")
    first = ms.load_state(click.filter(early)).write(f"{path}/1")
    second = ms.load_state(click.filter(~early | F.col("order_date").isNull()))
    return ms.metrics(ms.merge_states(first, second).write(f"{path}/2"))


def q_order_recency_rank(spark, sf_dir):
    return order_recency_rank(cs.stage(fx.clickstream(spark, sf_dir), "A"))


# --------------------------------------------------------------------------- shared constants

# Clock and object keys are parameters, fixed here so results are reproducible.
AS_OF = "2026-01-15 10:00:00"
FEED_KEY = "feeds/daily_orders.csv.pgp"
EARLIER_LOAD_BEFORE = "2000-01-01"          # orders of the earlier clickstream load
EARLIER_PARAMS = ApprovalParams(threshold=120_000, premium_rate=0.12, standard_rate=0.06,
                                standard_floor=1_500)  # the configuration of the earlier run
EARLIER_SEGMENTS_EXCLUDE = "HOUSEHOLD"      # segment whose applications arrive only today


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


# --------------------------------------------------------------------------- approvals

def _applications_csv(spark, sf_dir) -> str:
    """The applications fixture landed as a header CSV in the shared scratch folder."""
    path = scratch_path(spark, "applications_csv")
    fx.applications(spark, sf_dir).write.option("header", True).csv(path)
    return path


def q_approve_applications(spark, sf_dir):
    return ap.approve(rd.read_applications(spark, _applications_csv(spark, sf_dir)))


def _portfolio(spark, sf_dir, params=ApprovalParams()):
    return ap.approve(fx.applications(spark, sf_dir), params)


def q_approval_summary(spark, sf_dir):
    return ap.approval_summary(_portfolio(spark, sf_dir))


def q_tier_volumes(spark, sf_dir):
    return ap.tier_volumes(_portfolio(spark, sf_dir))


def q_ingest_stats(spark, sf_dir):
    return ap.ingest_stats(fx.applications(spark, sf_dir))


def q_route_premium(spark, sf_dir):
    return ap.route_premium(fx.applications(spark, sf_dir))


def q_route_standard(spark, sf_dir):
    return ap.route_standard(fx.applications(spark, sf_dir))


# A configuration as the runs get it: JSON that replaces every default.
CONFIG_JSON = """{"premium_income_threshold": 60000, "premium_rate": 0.1, "standard_rate": 0.05,
                  "standard_floor": 1000, "card_products": {"premium": "Gold", "standard": "Basic"}}"""


def q_approve_with_config(spark, sf_dir):
    return ap.approve(fx.applications(spark, sf_dir), ApprovalParams.from_json(CONFIG_JSON))


def q_combine_portfolios(spark, sf_dir):
    """The branches approved apart and put together again (a bag union)."""
    apps = fx.applications(spark, sf_dir)
    return ap.combine_portfolios(ap.approve(ap.route_premium(apps)), None, ap.approve(ap.route_standard(apps)))


def q_upsert_accounts(spark, sf_dir):
    """Earlier run (other parameters, all segments but one) merged, then today's run."""
    path = scratch_path(spark, "credit_accounts")
    cust = fx.table(spark, sf_dir, "customer")
    earlier = ap.approve(fx.applications(spark, sf_dir, cust.filter(F.col("c_mktsegment") != EARLIER_SEGMENTS_EXCLUDE)),
                         EARLIER_PARAMS)
    today = _portfolio(spark, sf_dir)
    no_stamp = {"last_updated": F.lit(None).cast("timestamp_ntz")}
    cols = list(ap.PORTFOLIO_COLUMNS)
    sk.merge_table(spark, path, earlier.select(*cols), ["application_id"], insert_values=no_stamp)
    sk.merge_table(spark, path, today.select(*cols), ["application_id"],
                   update_columns=["credit_limit"], set_on_match={"last_updated": as_of()},
                   insert_values=no_stamp)
    return sk.read_table(spark, path)


def q_skip_empty_load(spark, sf_dir):
    """A run whose load has no applications leaves the accounts as they are, and no new version."""
    path = scratch_path(spark, "credit_accounts")
    no_stamp = {"last_updated": F.lit(None).cast("timestamp_ntz")}
    today = _portfolio(spark, sf_dir).select(*ap.PORTFOLIO_COLUMNS)
    sk.merge_table(spark, path, today, ["application_id"], insert_values=no_stamp)
    sk.merge_table(spark, path, today.filter(F.col("annual_income") < 0), ["application_id"], update_columns=["credit_limit"],
                   set_on_match={"last_updated": as_of()}, insert_values=no_stamp)
    return sk.read_table(spark, path).withColumn("version", F.lit(sk.current_version(spark, path)))


# --------------------------------------------------------------------------- clickstream sinks

def q_merge_customer_metrics(spark, sf_dir):
    """Mart built from the earlier load, then merged with the full recomputation."""
    path = scratch_path(spark, "fct_customer_metrics")
    click = fx.clickstream(spark, sf_dir)
    earlier = cs.customer_metrics(cs.stage(click.filter(F.col("order_date") < F.lit(EARLIER_LOAD_BEFORE).cast("timestamp_ntz")), "A"))
    full = cs.customer_metrics(cs.stage(click, "A"))
    sk.merge_table(spark, path, earlier, ["customer_id"])
    sk.merge_table(spark, path, full, ["customer_id"])
    return sk.read_table(spark, path)


def q_insert_metrics_twice(spark, sf_dir):
    """Variant B's INSERT run twice: appends, so every customer appears twice."""
    path = scratch_path(spark, "py_customer_metrics")
    metrics = q_customer_metrics_b(spark, sf_dir)
    for _ in range(2):
        sk.append_table(metrics, path)
    return spark.read.parquet(path)


def q_append_raw_clickstream(spark, sf_dir):
    """A raw drop with other column order and one column more, read by name and appended to the raw table."""
    drop, path = scratch_path(spark, "raw_drop"), scratch_path(spark, "raw_clickstream")
    click = fx.clickstream(spark, sf_dir)
    click.select(F.lit("web").alias("channel"), *reversed(click.columns)).write.parquet(drop)
    sk.append_table(rd.read_clickstream(spark, drop), path)
    return spark.read.parquet(path)


# --------------------------------------------------------------------------- sales

def q_report_fan_out(spark, sf_dir):
    """The three reports as (dimension, label, n, amount), in one pass over the sales."""
    return sl.reports_in_one_pass(fx.sales(spark, sf_dir), ["by_store", "by_product", "by_day_of_week"])


def q_top_customers_by_revenue(spark, sf_dir):
    return sl.top_customers_by_revenue(fx.sales(spark, sf_dir))


def q_top_products_by_units(spark, sf_dir):
    return sl.top_products_by_units(fx.sales(spark, sf_dir))


def q_sales_by_day_of_week(spark, sf_dir):
    return sl.sales_by_day_of_week(fx.sales(spark, sf_dir))


def q_table_row_count(spark, sf_dir):
    return sl.table_row_count(fx.sales(spark, sf_dir))


# --------------------------------------------------------------------------- feed

def _landed(spark, sf_dir):
    return rd.with_lineage(fx.landing(spark, sf_dir), FEED_KEY, AS_OF).withColumn("_ingested_at", as_of())


def q_landing_with_lineage(spark, sf_dir):
    """Feed CSV -> lineage columns -> append to the landing table -> read back."""
    drop = scratch_path(spark, "feed_drop")
    fx.landing(spark, sf_dir).write.option("header", True).csv(drop)
    feed = rd.read_feed(spark, drop, types={"o_orderkey": "bigint"})
    landed = rd.with_lineage(feed, FEED_KEY, AS_OF).withColumn("_ingested_at", as_of())
    path = scratch_path(spark, "csv_landing_zone")
    # Partitioned by source file, so a later repair of one file reads and rewrites
    # only its partition (see operators.feed.repair_landing).
    sk.write_reconciled(landed, path, partition_by=["_source_file"])
    return spark.read.schema(landed.schema).parquet(path)


def _feed_of_other_types(spark, sf_dir) -> list[str]:
    """A feed in three parts; the third widens ``total`` (whole numbers before) and ``code`` (digits before)."""
    base = scratch_path(spark, "typed_feed")
    orders = fx.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    for k in range(FEED_FILES):
        total = F.col("o_totalprice").cast("string") if k == 2 else F.floor("o_totalprice").cast("string")
        code = F.concat(F.lit("C"), key) if k == 2 else key.cast("string")
        (orders.filter(key % FEED_FILES == k).select(
            "o_orderkey", F.when(key % 7 == 0, F.lit("NA")).otherwise(total).alias("total"), code.alias("code"),
            F.when(key % 2 == 0, F.lit("True")).otherwise(F.lit("false")).alias("urgent"),
            F.lit("").alias("note"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))
         .write.option("header", True).option("maxRecordsPerFile", PART_ROWS).csv(f"{base}/part{k}"))
    return [f"{base}/part{k}" for k in range(FEED_FILES)]


def q_feed_inferred(spark, sf_dir):
    """A feed read without declared types: each column's type comes from all values of all files; dates stay text."""
    return rd.read_feed(spark, _feed_of_other_types(spark, sf_dir))


FEED_FILES = 3  # the landing table holds the feed as so many files


def q_repair_landing(spark, sf_dir):
    """One file of several in the landing table is repaired; the others stay as they are."""
    path = scratch_path(spark, "landing_zone")
    rows = fx.landing(spark, sf_dir).withColumn("_source_file", F.concat(
        F.lit("orders_"), (F.col("o_orderkey") % FEED_FILES).cast("string"), F.lit(".csv")))
    sk.write_reconciled(rows, path, partition_by=["_source_file"])
    fd.repair_landing(spark, path, "orders_1.csv", scratch_path(spark, "landing_repair"))
    return spark.read.parquet(path)


def q_bad_date_count(spark, sf_dir):
    landed = _landed(spark, sf_dir)
    return fd.bad_date_count(landed, source_file=decrypted_name(FEED_KEY))


def q_normalize_dates(spark, sf_dir):
    return fd.normalize_dates(fx.landing(spark, sf_dir), mode="row")


def q_normalize_dates_by_column(spark, sf_dir):
    return fd.normalize_dates(fx.landing(spark, sf_dir), mode="column")


def q_ingest_audit(spark, sf_dir):
    """The run's audit row, appended to the audit table and read back."""
    landed = _landed(spark, sf_dir)
    row = (fd.audit_summary(landed, FEED_KEY, AS_OF, source_file=decrypted_name(FEED_KEY))
           .withColumn("logged_at", as_of()))
    path = scratch_path(spark, "csv_ingest_audit")
    sk.write_reconciled(row, path)
    return spark.read.parquet(path)


# --------------------------------------------------------------------------- data quality

STG, MART = "stg_clickstream", "fct_customer_metrics"


def q_dq_not_null(spark, sf_dir):
    return dq.not_null(q_staged_clickstream(spark, sf_dir), "customer_id", STG)


def q_dq_unique(spark, sf_dir):
    return dq.unique(q_customer_metrics(spark, sf_dir), "customer_id", MART)


def q_dq_unique_repeats(spark, sf_dir):
    return dq.unique(q_staged_clickstream(spark, sf_dir), "order_id", STG)


def q_dq_accepted_values(spark, sf_dir):
    return dq.accepted_values(q_staged_clickstream(spark, sf_dir), "browser", BROWSER_VALUES, STG)


def q_dq_accepted_values_violated(spark, sf_dir):
    return dq.accepted_values(q_staged_clickstream(spark, sf_dir), "browser", ("Chrome", "Safari"), STG)


def q_dq_report(spark, sf_dir):
    """The 22 checks of staging and mart, the row checks measured while the mart is written."""
    staged = q_staged_clickstream(spark, sf_dir)
    path = scratch_path(spark, "checked_mart")
    of_staged = dq.ObservedChecks(staged, STG, dq.STAGING_CHECKS)
    of_mart = dq.ObservedChecks(cs.customer_metrics(staged, observed=of_staged.rows), MART, dq.MART_CHECKS)
    of_mart.rows.write.parquet(path)
    return of_staged.report().unionByName(of_mart.report(spark.read.parquet(path)))


# --------------------------------------------------------------------------- streaming

VENDOR_TYPES = {"event_id": "bigint", "ts": "string", "user_id": "bigint", "event_type": "string", "value": "double"}
FEED_TYPES = {"o_orderkey": "bigint", "order_date": "string", "ship_date": "string"}
# Fixed value: the schema version reported for vendor drops.
SCHEMA_VERSION = "v3"
DROPS = 3  # the vendor table arrives as three drops; the last one after the first run
PART_ROWS = 2_000  # rows of a drop's part file, few enough for the test tables to come in many parts
BATCH_FILES = 64  # part files of a micro-batch


def _land_drop(df: DataFrame, path: str) -> None:
    """``df`` as a directory of CSV part files, which appears at ``path`` + the mark of complete drops when all are there."""
    parts = path.replace("/landing/", "/outside/")
    df.write.option("header", True).option("escape", '"').option("maxRecordsPerFile", PART_ROWS).csv(parts)
    path_of = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path_of(parts).getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path_of(path).getParent())
    fs.rename(path_of(parts), path_of(path + st.COMPLETE))


def _land_vendor_drop(spark, sf_dir, landing: str, k: int) -> None:
    """Drop 1 has its columns in another order, drop 2 line breaks within a quoted field."""
    events = fx.table(spark, sf_dir, "events").filter(F.col("event_id") % DROPS == k)
    columns = list(VENDOR_TYPES)
    if k == 1:
        columns = [*reversed(columns), "props"]
    if k == 2:
        events = events.withColumn("event_type", F.concat("event_type", F.lit("\nsecond line")))
    _land_drop(events.select(*columns), f"{landing}/vendor_data_{k}.csv")


def _vendor_runs(spark, sf_dir):
    base = scratch_path(spark, "vendor_drop")
    totals = None
    for arrivals in ((0, 1), (2,)):
        for k in arrivals:
            _land_vendor_drop(spark, sf_dir, f"{base}/landing", k)
        totals = process_vendor_drops(spark, f"{base}/landing", VENDOR_TYPES, f"{base}/work", f"{base}/archive",
                                      SCHEMA_VERSION, by="directory", max_files_per_batch=BATCH_FILES)
    return base, totals


def q_vendor_drop_counts(spark, sf_dir):
    """Drops of many part files arrive in two waves; each file is counted once across both runs."""
    return _vendor_runs(spark, sf_dir)[1]


def q_archive_processed(spark, sf_dir):
    """Drops that the stream moved to the archive, with their record counts and cold-storage path."""
    base, _ = _vendor_runs(spark, sf_dir)
    # The archive keeps the files' full paths; each drop has a header of its own, and only rows are counted.
    archived = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("recursiveFileLookup", True)
                .option("pathGlobFilter", "part-*").schema(", ".join(f"c{i} string" for i in range(len(VENDOR_TYPES))))
                .csv(f"{base}/archive").select("c0", "_metadata"))
    return (archived.groupBy(st.drop_name("directory").alias("file")).agg(F.count(F.lit(1)).alias("record_count"))
            .select("file", "record_count", cold_path("file").alias("cold_path")))


def _stream_feed(spark, sf_dir):
    """The feed as three drops of many part files: the second in another column order, the third with a line break in its junk
    dates."""
    base = scratch_path(spark, "feed_stream")
    feed = fx.landing(spark, sf_dir)
    for k in range(FEED_FILES):
        own = feed.filter(F.col("o_orderkey") % FEED_FILES == k)
        if k == 1:
            own = own.select("ship_date", "o_orderkey", "order_date")
        if k == 2:
            own = own.withColumn("order_date", F.regexp_replace("order_date", "not-a-date", "not a\ndate"))
        _land_drop(own, f"{base}/landing/orders_{k}.csv")
    audits = ingest_feed(spark, f"{base}/landing", FEED_TYPES, f"{base}/rows", f"{base}/audit", f"{base}/checkpoint",
                         AS_OF, drop_by="directory", max_files_per_batch=BATCH_FILES)
    return spark.read.parquet(f"{base}/rows"), audits


def q_streaming_feed_ingest(spark, sf_dir):
    """The stream lands and repairs the drops that arrived."""
    return _stream_feed(spark, sf_dir)[0].select("o_orderkey", "order_date", "ship_date")


def q_streaming_feed_audit(spark, sf_dir):
    """One audit row a drop."""
    return _stream_feed(spark, sf_dir)[1]


# --------------------------------------------------------------------------- ML

def _features(spark, sf_dir):
    docs, labels = fx.training_events(spark, sf_dir)
    return tn.prepare_features(docs, labels)


def _stored_features(spark, sf_dir):
    root = scratch_path(spark, "model_registry")
    return root, tn.write_features(_features(spark, sf_dir), root)


def q_prepare_features(spark, sf_dir):
    return _features(spark, sf_dir)


def q_feature_set(spark, sf_dir):
    """The stored feature set's rows, feature count and place."""
    return tn.feature_profile(_stored_features(spark, sf_dir)[1])


def q_candidate_scores(spark, sf_dir):
    return tn.tune_learning_rate(_stored_features(spark, sf_dir)[1])[1].drop("grid_order")


def q_best_candidate(spark, sf_dir):
    return tn.best_candidate(tn.tune_learning_rate(_stored_features(spark, sf_dir)[1])[1])


def q_tune_learning_rate(spark, sf_dir):
    """Tune, pick the winner, save it and append the registry row."""
    root, features = _stored_features(spark, sf_dir)
    weights, scores = tn.tune_learning_rate(features)
    return tn.register(weights, tn.best_candidate(scores), root, as_of=AS_OF)


def _fitted_features(spark, sf_dir):
    pipeline, rows = bt.fit_features(*fx.training_events(spark, sf_dir))
    path = scratch_path(spark, "fitted_features")
    rows.write.parquet(path)
    return pipeline, spark.read.schema(rows.schema).parquet(path)


def q_fitted_features(spark, sf_dir):
    """The three counts after imputation and scaling fitted on the training folds, and how many features there are."""
    rows = _fitted_features(spark, sf_dir)[1]
    return rows.select("doc_id", "label", *[F.col("x")[i].alias(c) for i, c in enumerate(bt.COUNTS)], F.size("x").alias("feature_count"))


def _boosted(spark, sf_dir):
    pipeline, rows = _fitted_features(spark, sf_dir)
    cuts = bt.quantile_cuts(rows.where(F.col("fold") < tn.FOLDS - 1))
    path = scratch_path(spark, "binned_features")
    bt.binned(rows, cuts).select("label", "fold", "b").write.parquet(path)
    return pipeline, cuts, *bt.boost(spark.read.parquet(path))


def q_boosted_candidate_scores(spark, sf_dir):
    """Held-out accuracy of boosted trees for each learning rate."""
    return _boosted(spark, sf_dir)[4].drop("grid_order")


def q_boosted_registry(spark, sf_dir):
    """The best rate's trees and fitted features saved and registered; the registry row, and every document's score by what was
    saved."""
    pipeline, cuts, start, models, scores = _boosted(spark, sf_dir)
    root = scratch_path(spark, "boosted_models")
    entry = bt.register_boosted(pipeline, cuts, start, models, tn.best_candidate(scores), root, as_of=AS_OF).first()
    scored = bt.score_documents(spark, root, entry, fx.table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "margin", "predicted", *[F.lit(entry[c]).alias(c) for c in ("version", "model_path", "features_path", "learning_rate", "accuracy")])


QUERIES: dict[str, Query] = {
    "approve_applications": q_approve_applications,
    "approval_summary": q_approval_summary,
    "tier_volumes": q_tier_volumes,
    "ingest_stats": q_ingest_stats,
    "route_premium": q_route_premium,
    "route_standard": q_route_standard,
    "approve_with_config": q_approve_with_config,
    "combine_portfolios": q_combine_portfolios,
    "upsert_accounts": q_upsert_accounts,
    "skip_empty_load": q_skip_empty_load,
    "staged_clickstream": q_staged_clickstream,
    "staged_clickstream_b": q_staged_clickstream_b,
    "customer_metrics": q_customer_metrics,
    "customer_metrics_b": q_customer_metrics_b,
    "customer_metrics_windowed": q_customer_metrics_windowed,
    "customer_metrics_bucketed": q_customer_metrics_bucketed,
    "customer_metrics_merged": q_customer_metrics_merged,
    "order_recency_rank": q_order_recency_rank,
    "merge_customer_metrics": q_merge_customer_metrics,
    "insert_metrics_twice": q_insert_metrics_twice,
    "append_raw_clickstream": q_append_raw_clickstream,
    "top_customers_by_revenue": q_top_customers_by_revenue,
    "top_products_by_units": q_top_products_by_units,
    "sales_by_day_of_week": q_sales_by_day_of_week,
    "table_row_count": q_table_row_count,
    "report_fan_out": q_report_fan_out,
    "landing_with_lineage": q_landing_with_lineage,
    "feed_inferred": q_feed_inferred,
    "repair_landing": q_repair_landing,
    "bad_date_count": q_bad_date_count,
    "normalize_dates": q_normalize_dates,
    "normalize_dates_by_column": q_normalize_dates_by_column,
    "ingest_audit": q_ingest_audit,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_unique_repeats": q_dq_unique_repeats,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_accepted_values_violated": q_dq_accepted_values_violated,
    "dq_report": q_dq_report,
    "vendor_drop_counts": q_vendor_drop_counts,
    "streaming_feed_ingest": q_streaming_feed_ingest,
    "streaming_feed_audit": q_streaming_feed_audit,
    "archive_processed": q_archive_processed,
    "prepare_features": q_prepare_features,
    "feature_set": q_feature_set,
    "candidate_scores": q_candidate_scores,
    "best_candidate": q_best_candidate,
    "tune_learning_rate": q_tune_learning_rate,
    "fitted_features": q_fitted_features,
    "boosted_candidate_scores": q_boosted_candidate_scores,
    "boosted_registry": q_boosted_registry,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
