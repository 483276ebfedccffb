"""Streaming form of the feed ingest: arrive -> lineage -> repair -> land -> audit.

Each micro-batch holds the rows of newly arrived files. The batch is persisted
once (it feeds two writes), its dates are repaired in ``row`` mode, the rows are
written to the landing table and one audit row per source file is written to the
audit table. Both writes go to the batch's own partition, so a retried batch does
not duplicate anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.operators.feed import DATE_COLUMNS, SUCCESS, needs_repair, normalize_dates
from sparkwright.streaming.arrival import archived_run, batch_rows, drop_name, write_batch


def feed_batch_writer(landing_path: str, audit_path: str, types: dict[str, str], as_of=None, cols=DATE_COLUMNS,
                      mode: str = "row", drop_by: str = "file"):
    """A ``foreachBatch`` function that lands and audits the files of one micro-batch."""
    stamp = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = (batch_rows(batch, types, drop_by).withColumns({"_source_file": drop_name(drop_by), "_ingested_at": stamp})
                .drop("_metadata")
                .withColumn("_needs_repair", needs_repair(cols))
                .persist())
        try:
            repaired = normalize_dates(rows, cols, mode=mode).drop("_needs_repair")
            write_batch(repaired, landing_path, batch_id)
            audit = rows.groupBy("_source_file").agg(
                F.count(F.lit(1)).alias("rows_loaded"),
                F.count(F.when(F.col("_needs_repair"), F.lit(1))).alias("date_fixes_applied"),
            ).select(F.col("_source_file").alias("source_file"), "rows_loaded", "date_fixes_applied",
                     F.lit(SUCCESS).alias("status"), stamp.alias("logged_at"))
            write_batch(audit, audit_path, batch_id)
        finally:
            rows.unpersist()

    return handle


def audit_totals(audits: DataFrame) -> DataFrame:
    """One audit row per source file, whatever batches its parts came in."""
    return audits.groupBy("source_file", "status").agg(
        F.sum("rows_loaded").cast("bigint").alias("rows_loaded"),
        F.sum("date_fixes_applied").cast("bigint").alias("date_fixes_applied"),
        F.max("logged_at").alias("logged_at"),
    ).select("source_file", "rows_loaded", "date_fixes_applied", "status", "logged_at")


def ingest_feed(spark: SparkSession, landing: str, types: dict[str, str], landing_path: str, audit_path: str,
                checkpoint: str, as_of=None, drop_by: str = "file", max_files_per_batch: int | None = 1000,
                archive_dir: str | None = None) -> DataFrame:
    """Process every feed drop that has arrived at ``landing`` since the last run; returns the audit totals so far.

    ``drop_by="directory"``: drops are directories of part files, complete when renamed to ``<name>.complete``. A backlog
    is cut into micro-batches of at most ``max_files_per_batch`` files, so the persisted batch stays bounded however many
    files have piled up. With ``archive_dir`` the processed files are moved there.
    """
    archived_run(spark, landing, feed_batch_writer(landing_path, audit_path, types, as_of, drop_by=drop_by), checkpoint,
                 drop_by, max_files_per_batch, archive_dir)
    return audit_totals(spark.read.parquet(audit_path))
