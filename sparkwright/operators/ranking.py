"""RANK() within a key, without putting a whole key group into one task.

A window partitioned by the key sorts each key group inside one task, which a hot key makes as large as its group.

``RANK() OVER (PARTITION BY key ORDER BY o DESC)`` only depends on how many rows of
the same key sort strictly before a row, so it is computed from counts per
(key, o) instead of from the raw rows:

1. ``counts``: rows per (key, o) — a partial + final aggregate, so a hot tie group
   collapses map-side.
2. The counts are range-partitioned on (key, o). Range bounds are sampled over the
   composite key, so one hot key with many distinct ``o`` values is spread over
   several tasks; a (key, o) pair is never split. The partitioned counts are
   checkpointed to the shared checkpoint folder so the partition ids used below
   are fixed and survive executor loss.
3. Inside each (partition, key): a running sum of the counts before the row.
4. Per (partition, key): the total; per key, the running sum of the totals of the
   earlier partitions (at most one row per partition and key).
5. rank = 1 + (3) + (4), joined back to the rows on (key, o) with NULL-safe
   equality (NULL keys and NULL ``o`` form groups, as in SQL windows). A hot
   (key, o) pair on the row side of that join is split by adaptive skew-join
   handling, because the count side is unique per pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.session import ensure_checkpoint_dir


def rank_within(df: DataFrame, key: str, order_col: str, out: str = "rank",
                descending: bool = True) -> DataFrame:
    """``df`` plus ``out`` = RANK() OVER (PARTITION BY key ORDER BY order_col [DESC] NULLS FIRST)."""
    o = F.col(order_col)
    o_sort = o.desc_nulls_first() if descending else o.asc_nulls_first()
    ensure_checkpoint_dir(df.sparkSession)

    counts = df.groupBy(key, order_col).agg(F.count(F.lit(1)).alias("_n"))
    spread = (counts.repartitionByRange(F.col(key).asc_nulls_first(), o_sort)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))

    local_w = (Window.partitionBy("_pid", key).orderBy(o_sort)
               .rowsBetween(Window.unboundedPreceding, -1))
    local = spread.withColumn("_before_local", F.coalesce(F.sum("_n").over(local_w), F.lit(0)))

    part_w = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (spread.groupBy("_pid", key).agg(F.sum("_n").alias("_tot"))
               .withColumn("_before_parts", F.coalesce(F.sum("_tot").over(part_w), F.lit(0)))
               .select(F.col("_pid").alias("_opid"), F.col(key).alias("_okey"), "_before_parts"))

    ranks = (local.join(offsets, (local["_pid"] == offsets["_opid"]) & local[key].eqNullSafe(offsets["_okey"]))
             .select(F.col(key).alias("_rkey"), F.col(order_col).alias("_rord"),
                     (F.lit(1) + F.col("_before_local") + F.col("_before_parts")).cast("bigint").alias(out)))

    cond = df[key].eqNullSafe(ranks["_rkey"]) & df[order_col].eqNullSafe(ranks["_rord"])
    return df.join(ranks, cond).select(*[df[c] for c in df.columns], ranks[out])


def order_recency_rank(staged: DataFrame) -> DataFrame:
    """Staged rows plus ``order_rank``: 1 = newest order of the customer, ties share a rank."""
    return rank_within(staged, "customer_id", "order_date", out="order_rank", descending=True)
