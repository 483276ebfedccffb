"""Customer metrics as a state that loads merge into.

A load's rows are reduced to two small tables, both mergeable in any order:

* ``orders``: (customer, range of order ids) -> bitmap of the ids seen, by ``bitmap_construct_agg``; merged by ``bitmap_or_agg``,
  so an order that comes in two loads counts once;
* ``totals``: customer -> sums, row counts and label counts; merged by adding.

``metrics`` turns a state into the same rows as ``clickstream.customer_metrics`` over all loads together. A load
costs its own rows and the state, not the history. A customer with a large share of all rows is combined in the tasks, and its
ids are spread over the ranges. A bitmap covers 32,768 ids in 4 kB, mostly zeros that compress; it pays where a customer's ids lie
close together or are many, and never grows beyond the range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.decimals import TOTAL, money_sum
from sparkwright.functions.useragent import BROWSER_VALUES, OS_VALUES

KEY = ["_ck", "_cn"]  # groups like customer_id, NULL included, and joins by plain equality
_SUMS = ("subtotal", "tax", "spend")
_LABELS = {"browser": sorted(BROWSER_VALUES), "os": sorted(OS_VALUES)}


@dataclass(frozen=True)
class MetricsState:
    orders: DataFrame
    totals: DataFrame

    def write(self, path: str) -> MetricsState:
        """Stores the state below ``path`` and reads it again."""
        self.orders.write.parquet(f"{path}/orders")
        self.totals.write.parquet(f"{path}/totals")
        return MetricsState.read(self.orders.sparkSession, path)

    @staticmethod
    def read(spark: SparkSession, path: str) -> MetricsState:
        return MetricsState(spark.read.parquet(f"{path}/orders"), spark.read.parquet(f"{path}/totals"))


def _label_counts() -> list[tuple[str, str, str]]:
    return [(f"{kind}_{i}", kind, label) for kind, labels in _LABELS.items() for i, label in enumerate(labels)]


def load_state(staged: DataFrame) -> MetricsState:
    """The state of one load's staged rows (``clickstream.stage``, variant A)."""
    rows = staged.withColumns({"_ck": F.coalesce(F.col("customer_id"), F.lit(0)), "_cn": F.col("customer_id").isNull(),
                               "spend": F.col("subtotal") + F.col("tax")})
    ids = rows.filter(F.col("order_id").isNotNull())
    orders = ids.groupBy(*KEY, F.bitmap_bucket_number("order_id").alias("range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("order_id")).alias("seen"))
    totals = rows.groupBy(*KEY).agg(
        *[money_sum(c).alias(c) for c in _SUMS],
        F.sum(F.col("session_duration_secs").cast("decimal(38,0)")).alias("session"), F.count("session_duration_secs").alias("sessions"),
        *[F.count(F.when(F.col(kind) == label, 1)).alias(name) for name, kind, label in _label_counts()])
    return MetricsState(orders, totals)


def merge_states(a: MetricsState, b: MetricsState) -> MetricsState:
    orders = a.orders.unionByName(b.orders).groupBy(*KEY, "range").agg(F.bitmap_or_agg("seen").alias("seen"))
    counts = ["sessions", *[name for name, _, _ in _label_counts()]]
    totals = a.totals.unionByName(b.totals).groupBy(*KEY).agg(
        *[F.sum(c).cast(TOTAL).alias(c) for c in _SUMS], F.sum("session").cast("decimal(38,0)").alias("session"),
        *[F.sum(c).cast("bigint").alias(c) for c in counts])
    return MetricsState(orders, totals)


def _favourite(kind: str) -> Column:
    labels = _LABELS[kind]
    best = F.array_max(F.array(*[F.struct(F.col(f"{kind}_{i}").alias("n"), F.lit(len(labels) - i).alias("first"), F.lit(label).alias("label"))
                                 for i, label in enumerate(labels)]))
    return F.when(~F.col("_cn") & (best["n"] > 0), best["label"])


def metrics(state: MetricsState) -> DataFrame:
    """One row per customer, as ``clickstream.customer_metrics`` (variant A) over all merged loads."""
    orders = state.orders.groupBy(*KEY).agg(F.sum(F.bitmap_count("seen")).cast("bigint").alias("total_orders"))
    n = "CAST(sessions AS DECIMAL(38,0))"
    # Hundredths of the mean, halves away from zero.
    hundredths = f"CASE WHEN session >= 0 THEN (200 * session + {n}) div (2 * {n}) ELSE -((-200 * session + {n}) div (2 * {n})) END"
    mean = F.expr(f"CASE WHEN sessions > 0 THEN CAST(CAST({hundredths} AS DECIMAL(38,0)) * 0.01BD AS DECIMAL(18,2)) END")
    return state.totals.join(orders, KEY, "left").select(
        F.when(~F.col("_cn"), F.col("_ck")).alias("customer_id"), F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        F.col("subtotal").alias("total_subtotal"), F.col("tax").alias("total_tax"), F.col("spend").alias("total_spend"),
        mean.alias("avg_session_duration_secs"), _favourite("browser").alias("most_common_browser"), _favourite("os").alias("most_common_os"))
