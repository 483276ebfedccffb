"""Feed landing: date repair, bad-date counts, audit rows.

The source pipeline appends the feed and then runs an UPDATE over the landed rows
of the same file. Here the repair is a projection applied before (or while)
writing, and the count of rows needing repair comes from the same pass.

Repair modes:

* ``row`` (the source behaviour): when *either* date of a row is not ISO, *both*
  are re-read as ``MM/dd/yyyy`` and printed as ISO, so an ISO companion value, a
  NULL or junk becomes NULL.
* ``column``: each column is repaired on its own; ISO values are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.dates import any_bad, is_iso_date, us_to_iso

# The repaired date columns of the feed and the audit status of a run.
DATE_COLUMNS = ("order_date", "ship_date")
SUCCESS = "SUCCESS"


def _in_scope(source_file: str | None) -> Column:
    return F.lit(True) if source_file is None else (F.col("_source_file") == F.lit(source_file))


def needs_repair(cols=DATE_COLUMNS, source_file: str | None = None) -> Column:
    return _in_scope(source_file) & any_bad(list(cols))


def bad_date_count(df: DataFrame, cols=DATE_COLUMNS, source_file: str | None = None) -> DataFrame:
    """Rows whose dates need repair (counted before the repair; NULL dates count)."""
    return df.agg(F.count(F.when(needs_repair(cols, source_file), F.lit(1))).alias("bad_dates"))


def normalize_dates(df: DataFrame, cols=DATE_COLUMNS, mode: str = "row",
                    source_file: str | None = None) -> DataFrame:
    """Repair the date columns (see module doc); other columns and rows pass through."""
    if mode == "row":
        bad = needs_repair(cols, source_file)
        return df.withColumns({c: F.when(bad, us_to_iso(c)).otherwise(F.col(c)) for c in cols})
    if mode == "column":
        scope = _in_scope(source_file)
        return df.withColumns({c: F.when(scope & ~is_iso_date(c), us_to_iso(c)).otherwise(F.col(c))
                               for c in cols})
    raise ValueError(f"unknown repair mode {mode!r}")


def repair_landing(spark: SparkSession, landing_path: str, source_file: str, staging_path: str,
                   cols=DATE_COLUMNS, mode: str = "row") -> int:
    """Repair the dates of every landed row of ``source_file``, earlier loads included.

    The landing table is partitioned by ``_source_file``, so only that partition is
    read (partition pruning) and rewritten. The repaired rows are first written to
    ``staging_path`` (a path cannot be overwritten while it is being read), then
    replace the file's partition by dynamic partition overwrite, and are deleted. Returns the number
    of rows that needed repair. A failed run can simply be repeated: staged rows that are complete (``_SUCCESS``)
    are published first, so a partition that was removed but not replaced comes
    back. ``column`` mode is idempotent; ``row`` mode, like the source
    UPDATE, treats a NULL date as bad on every run, so another run also clears an
    ISO companion of a NULL.
    """
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path_of(staging_path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def publish() -> None:
        (spark.read.parquet(staging_path).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_source_file").parquet(landing_path))
        fs.delete(path_of(staging_path), True)

    if fs.exists(path_of(staging_path, "_SUCCESS")):
        publish()
    rows = spark.read.parquet(landing_path).filter(F.col("_source_file") == F.lit(source_file))
    bad = rows.agg(F.count(F.when(needs_repair(cols), F.lit(1))).alias("n")).first()["n"]
    if bad == 0:
        return 0
    normalize_dates(rows, cols, mode=mode).write.mode("overwrite").parquet(staging_path)
    publish()
    return int(bad)


def audit_summary(df: DataFrame, source_key: str, as_of, cols=DATE_COLUMNS,
                  source_file: str | None = None) -> DataFrame:
    """One audit row computed from the loaded rows in one pass:
    source key, rows loaded, date fixes applied, status, logged at."""
    return df.agg(
        F.lit(source_key).alias("source_file"),
        F.count(F.lit(1)).alias("rows_loaded"),
        F.count(F.when(needs_repair(cols, source_file), F.lit(1))).alias("date_fixes_applied"),
        F.lit(SUCCESS).alias("status"),
        F.lit(as_of).cast("timestamp").alias("logged_at"),
    )


def audit_row(spark: SparkSession, source_key: str, rows: int, fixes: int, as_of) -> DataFrame:
    """One audit row from already-known counts (for example from an Observation)."""
    return spark.range(1).select(
        F.lit(source_key).alias("source_file"),
        F.lit(rows).cast("bigint").alias("rows_loaded"),
        F.lit(fixes).cast("bigint").alias("date_fixes_applied"),
        F.lit(SUCCESS).alias("status"),
        F.lit(as_of).cast("timestamp").alias("logged_at"),
    )
