"""Measure how evenly post-shuffle tasks share the work when one key is hot.

Builds clickstream-shaped rows where one customer holds a third of all rows, runs
the flagship metrics, the recency rank (hot-key plan) and, for contrast, a plain
per-customer window, with Spark's event log written to a fresh scratch folder.
For every stage that reads at least 1% of the rows from a shuffle it reports the
largest share of the stage's shuffle records read by one task (1 / 16 would be
perfectly even here; the hot key alone is 1 / 3). Prints one JSON object.

Usage: python tools/skew_probe.py [rows]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def skewed_clickstream(spark, rows: int):
    from pyspark.sql import functions as F
    ids = spark.range(0, rows, numPartitions=16)
    hot = F.col("id") % 3 == 0  # one customer holds a third of the rows
    return ids.select(
        (F.col("id") + 100_000).alias("order_id"),
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 5000 + 1000).alias("customer_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).cast("timestamp_ntz").alias("order_date"),
        (F.col("id") % 997 + 1).cast("decimal(12,2)").alias("subtotal"),
        (F.col("id") % 13).cast("decimal(12,2)").alias("tax"),
        F.concat(F.lit("clk-"), F.col("id").cast("string")).alias("click_id"),
        F.when(F.col("id") % 2 == 0, F.lit("Mozilla/5.0 (X11; Linux x86_64) Firefox/121.0"))
         .otherwise(F.lit("Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36")).alias("user_agent"),
        (F.col("id") % 1791 + 10).cast("int").alias("session_duration_secs"),
    )


def shuffle_records(log_dir: str) -> int:
    """All shuffle records read by all tasks of the run."""
    total = 0
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    total += (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
    return total


def stage_shares(log_dir: str, min_records: int = 0) -> list[dict]:
    """Per stage reading at least ``min_records`` shuffle records: tasks, records and
    the largest share of them read by a single task."""
    reads = defaultdict(list)
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                reads[(ev["Stage ID"], ev["Stage Attempt ID"])].append(n)
    out = []
    for (stage, _), recs in sorted(reads.items()):
        total = sum(recs)
        if total and total >= min_records:
            out.append({"stage": stage, "tasks": len(recs), "records": total,
                        "max_task_share": round(max(recs) / total, 3)})
    return out


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 300_000
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    from sparkwright.operators import clickstream as cs
    from sparkwright.operators.ranking import rank_within
    from sparkwright.session import BASE_CONF
    from sparkwright.operators import sales as sl
    from sparkwright.sinks.tables import merge_frames

    def hot_product_report(df):
        # sales rows where one product holds a third of the rows
        sales = df.select(F.col("customer_id").alias("customerID"),
                          F.when(F.col("customer_id") == 7, F.lit("hot"))
                           .otherwise(F.concat(F.lit("p"), (F.col("order_id") % 500).cast("string"))).alias("product"),
                          F.col("order_date").alias("dateTime"), (F.col("session_duration_secs") % 9 + 1).alias("quantity"),
                          F.col("subtotal").cast("decimal(10,2)").alias("unitPrice"))
        return sl.top_products_by_units(sales)

    def null_heavy_merge(df):
        # a third of target and source rows carry a NULL key (they can never match)
        keyed = df.select(F.when(F.col("customer_id") == 7, F.lit(None)).otherwise(F.col("order_id"))
                          .cast("bigint").alias("k"), "subtotal", "click_id")
        source = keyed.withColumn("subtotal", F.col("subtotal") + 1)
        return merge_frames(keyed, source, ["k"], broadcast_source=False)

    results = {}
    cases = {
        "customer_metrics": lambda df: cs.customer_metrics(cs.stage(df)),
        "rank_hot_key_plan": lambda df: rank_within(cs.stage(df), "customer_id", "order_date",
                                                    out="order_rank"),
        "merge_null_heavy_keys": null_heavy_merge,
        "top_products_hot_product": hot_product_report,
        "plain_window_contrast": lambda df: cs.stage(df).withColumn(
            "r", F.rank().over(Window.partitionBy("customer_id").orderBy(F.col("order_date").desc()))),
    }
    for name, build in cases.items():
        log_dir = tempfile.mkdtemp(prefix=f"skew-{name}-")
        builder = SparkSession.builder.master("local[8]").appName(f"skew-{name}")
        for k, v in BASE_CONF.items():
            builder = builder.config(k, v)
        # Joins are measured as they run at scale, where these sides are far above the
        # broadcast threshold (a runtime broadcast build reads map outputs whole).
        spark = (builder.config("spark.sql.shuffle.partitions", "16")
                 .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
                 .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
                 .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
                 .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
                 .getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
        build(skewed_clickstream(spark, rows)).write.format("noop").mode("overwrite").save()
        spark.stop()
        shares = stage_shares(log_dir, min_records=rows // 100)  # skip tiny final stages
        results[name] = {"max_task_share": max((s["max_task_share"] for s in shares), default=0.0),
                         "shuffled_per_input_row": round(shuffle_records(log_dir) / rows, 4),
                         "stages": shares}
    print(json.dumps({"rows": rows, "hot_key_share": 0.333, "results": results}))


if __name__ == "__main__":
    main()
