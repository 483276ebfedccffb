"""File-arrival ingestion with Structured Streaming.

A file stream with ``trigger(availableNow=True)`` and a checkpoint hands over every file that has landed since the
previous run exactly once and then stops, which is what a "wait for the file, then process exactly that file"
step needs without a polling loop. A drop is a plain file, or a directory of part files that its writer renames to
``<name>.complete`` when all parts are there: the stream's path asks for that mark, so no part of an unfinished drop is ever seen.

The stream carries the files' names only; each micro-batch reads its files, all parts of all its drops in one
read, with the batch reader (``sources.readers.read_drops``), so batch and stream share one CSV dialect: columns bind
by header name, quoted line breaks are legal, and a malformed value fails the run.

Batch outputs are written to a ``batch_id`` partition with dynamic partition overwrite, so a retried micro-batch
replaces its own output instead of appending a second copy.

Processed files are moved by the stream's own ``cleanSource=archive``. Spark moves a batch's files when the next batch
begins, so ``archived_run`` ends with a closing batch: a file of its own that the batch function never sees.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.paths import ENCRYPTED_SUFFIX, cold_path
from sparkwright.sources.readers import read_drops

COMPLETE = ".complete"  # ends the name of a drop's directory when all its parts are there
CLOSING = "closing-"  # begins the name of a closing batch's file


def drops_at(landing: str, by: str = "file") -> str:
    """The path that a stream of ``landing``'s drops loads."""
    return landing if by == "file" else f"{landing}/*{COMPLETE}"


def arrival_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """Streaming (path) of the files landing at ``path`` (globs allowed); their content isn't read.

    With ``archive_dir`` a file is moved there, below its full path, once the batch after its own begins.
    """
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(path).select("path")


def run_available(stream: DataFrame, batch_fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything that has arrived, once, then return (raises if a batch failed)."""
    query = (stream.writeStream.foreachBatch(batch_fn).trigger(availableNow=True)
             .option("checkpointLocation", checkpoint).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")


def archived_run(spark: SparkSession, landing: str, batch_fn: Callable[[DataFrame, int], None], checkpoint: str, by: str = "file",
                 max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> None:
    """``run_available`` over the drops at ``landing``; with ``archive_dir``, all that was processed has been moved when it returns."""
    def run() -> None:
        run_available(arrival_stream(spark, drops_at(landing, by), max_files_per_trigger, archive_dir), files_only, checkpoint)

    def files_only(batch: DataFrame, batch_id: int) -> None:
        own = batch.filter(~F.element_at(F.split("path", "/"), -1).startswith(CLOSING))
        if not own.isEmpty():
            batch_fn(own, batch_id)

    if archive_dir is None:
        return run()
    setting = "spark.sql.streaming.fileSource.cleaner.numThreads"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "0")  # moved before the batch goes on, not by threads that the stream's end cuts off
    try:
        run()
        name = f"{CLOSING}{uuid.uuid4().hex[:12]}"
        _touch(spark, os.path.join(landing, name if by == "file" else f"{name}{COMPLETE}/{name}"))
        run()
    finally:
        spark.conf.set(setting, before)


def _touch(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place).close()


def batch_rows(batch: DataFrame, types: dict[str, str], by: str = "file") -> DataFrame:
    """The typed rows of a micro-batch's files, with ``_metadata``. Only the file names pass the driver, at most
    the stream's ``max_files_per_trigger`` of them."""
    return read_drops(batch.sparkSession, sorted(r["path"] for r in batch.collect()), types, by=by)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent per-batch append: (re)writes only this batch's partition."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def drop_name(by: str = "file") -> Column:
    """Name of the drop a row came from: its file, or the directory of a multi-part drop (without its mark)."""
    if by == "file":
        name = F.col("_metadata.file_name")
    elif by == "directory":
        # Parent directory of the file (split, not a backtracking regex, per row).
        name = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2), "\\" + COMPLETE + "$", "")
    else:
        raise ValueError(f"drops are named by file or by directory, not by {by!r}")
    return F.regexp_replace(name, "\\" + ENCRYPTED_SUFFIX + "$", "")


def schema_fingerprint(df: DataFrame) -> str:
    """A short version tag derived from the data columns' names and types (metadata only)."""
    cols = [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields if f.name != "_metadata"]
    return "s" + hashlib.sha1(",".join(cols).encode()).hexdigest()[:8]


def drop_payload(df: DataFrame, schema_version: str | None = None, by: str = "file") -> DataFrame:
    """Per drop in ``df``: file, record_count, schema_version, cold_path.

    ``schema_version`` defaults to the fingerprint of the declared columns.
    """
    schema_version = schema_version or schema_fingerprint(df)
    return (df.groupBy(drop_name(by).alias("file"))
            .agg(F.count(F.lit(1)).alias("record_count"))
            .select("file", "record_count", F.lit(schema_version).alias("schema_version"),
                    cold_path("file").alias("cold_path")))


def drop_totals(payloads: DataFrame) -> DataFrame:
    """Sum per-batch payload rows per drop (a drop of several files may span micro-batches)."""
    return (payloads.groupBy("file", "schema_version", "cold_path")
            .agg(F.sum("record_count").cast("bigint").alias("record_count"))
            .select("file", "record_count", "schema_version", "cold_path"))
