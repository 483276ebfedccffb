"""Append writers, and keyed merges into tables of hash buckets.

Layout of a merged table at ``path``::

    path/v=000001/key_bucket=7/part-*.parquet   the rows of one bucket of keys, as one commit wrote them
    path/v=000001/key_bucket=-1/part-*.parquet  rows with a NULL key that this commit added
    path/_log/part-*.parquet                    one row per commit: (version, operation, rows, buckets, touched)

A row's bucket is the hash of its keys, as Spark's own shuffle hashes them. A merge reads the buckets that hold
a key of its source, and rewrites only these; the others stay where an earlier commit wrote them. Rows with a NULL
key never match, so they are only ever added. A version is visible once its log row exists; the log row is written
after the data, so a failed job leaves at most an unreferenced directory behind, and readers never see half a version: a
bucket is read from the latest committed version that rewrote it.

``append_table`` writes a plain parquet directory in append mode (the landing and
audit tables are append-only).

One writer per merged table at a time is assumed (as for a scheduled job); two
concurrent merges would both claim the next version number.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkwright.functions.sizes import BROADCAST_BYTES, row_bytes


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system that serves it."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 columns: list[str] | None = None, mode: str = "append") -> int:
    """Write ``df`` (optionally reordered to ``columns``) and return the rows written.

    The count comes from an Observation on the write itself, not from a second scan.
    """
    obs = Observation()
    out = df.select(*columns) if columns else df
    writer = out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get["rows"])


def write_reconciled(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Append ``df`` to the parquet files at ``path``, having checked the write.

    The rows are first written to a staging folder of this write (readers of ``path`` skip it); rows observed while
    writing must equal the rows readable from it (counted from parquet metadata). Only then its files move
    to ``path``. Neither the table's history nor another writer's files are counted.
    """
    spark = df.sparkSession
    staging = os.path.join(path, f"_staging-{uuid.uuid4().hex}")
    written = append_table(df, staging, partition_by=partition_by)
    landed = spark.read.schema(df.schema).parquet(staging).count()
    if landed != written:
        raise IOError(f"write to {path} reported {written} rows but {landed} are readable")
    _move_files(spark, staging, path)
    return written


def _move_files(spark: SparkSession, source: str, target: str) -> None:
    """Moves the data files below ``source`` to the same places below ``target`` and deletes ``source``."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = path_of(source)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = fs.makeQualified(root).toUri().getPath()
    files = fs.listFiles(root, True)
    while files.hasNext():
        file = files.next().getPath()
        if not file.getName().startswith(("_", ".")):
            place = path_of(target, file.toUri().getPath().removeprefix(base).lstrip("/"))
            fs.mkdirs(place.getParent())
            if not fs.rename(file, place):
                raise IOError(f"{file.toString()} could not be moved to {place.toString()}")
    fs.delete(root, True)


# --------------------------------------------------------------------------- merged tables

BUCKET = "key_bucket"
BUCKET_BYTES = 128 * 1024 ** 2  # of source rows, for the number of buckets of a new table
LEAST_BUCKETS = 8
UNKEYED = -1  # the bucket of rows with a NULL key
_BITS = 32_768  # positions of one bitmap of bitmap_construct_agg
MOST_BITMAPS = 32  # so many bitmaps are observed at most; a source of more rows is joined by a shuffle


def _log_path(path: str) -> str:
    return os.path.join(path, "_log")


def _version_path(path: str, version: int) -> str:
    return os.path.join(path, f"v={version:06d}")


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(_log_path(path)) if path_exists(spark, _log_path(path)) else None


@dataclass(frozen=True)
class TableState:
    """What the log says of a table: its version (0: none yet), number of buckets, and the versions that hold each bucket's rows."""

    path: str
    version: int = 0
    buckets: int = 0
    versions: dict[int, list[int]] = field(default_factory=dict)

    @staticmethod
    def of(spark: SparkSession, path: str, version: int | None = None) -> TableState:
        log = _log(spark, path)
        if log is None:
            return TableState(path)
        commits = log if version is None else log.filter(F.col("version") <= version)
        # One job; the driver sees bucket and version numbers only.
        rows = (commits.select("version", "buckets", F.explode("touched").alias("bucket")).groupBy("bucket")
                .agg(F.sort_array(F.collect_set("version")).alias("versions"), F.max("buckets").alias("buckets")).collect())
        # A bucket is read where it was last rewritten, rows without a key wherever they were added.
        versions = {r["bucket"]: r["versions"] if r["bucket"] == UNKEYED else r["versions"][-1:] for r in rows}
        return TableState(path, max((v[-1] for v in versions.values()), default=0), max((r["buckets"] for r in rows), default=0), versions)

    def places(self, buckets: list[int] | None = None) -> list[str]:
        """Where the rows of ``buckets`` (default: all) lie."""
        return [os.path.join(_version_path(self.path, v), f"{BUCKET}={b}") for b in sorted(self.versions)
                if buckets is None or b in buckets for v in self.versions[b]]


def current_version(spark: SparkSession, path: str) -> int:
    """Highest committed version, 0 when the table does not exist yet."""
    return TableState.of(spark, path).version


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    state = TableState.of(spark, path, version)
    if not state.version:
        raise FileNotFoundError(f"no committed version at {path}")
    return spark.read.parquet(*state.places())


def _commit(spark: SparkSession, path: str, version: int, operation: str, rows: int, buckets: int, touched: list[int]) -> None:
    spark.range(1).coalesce(1).select(
        F.lit(version).alias("version"), F.lit(operation).alias("operation"), F.lit(rows).cast("bigint").alias("rows"),
        F.lit(buckets).alias("buckets"), F.array(*map(F.lit, touched)).cast("array<int>").alias("touched"),
        F.current_timestamp().alias("committed_at")).write.mode("append").parquet(_log_path(path))


def bucket_of(keys: list[str], buckets: int, prefix: str = "") -> Column:
    """The bucket of a row: that of Spark's hash partitioning by the keys, so that after a ``repartition(buckets, *keys)`` a
    task holds one bucket. Rows with a NULL key are in ``UNKEYED``."""
    own = [F.col(prefix + k) for k in keys]
    return F.when(_all_keys_known(keys, prefix), F.pmod(F.hash(*own), F.lit(buckets))).otherwise(F.lit(UNKEYED))


def _write_buckets(df: DataFrame, keys: list[str], buckets: int, target: str, mode: str) -> int:
    """Writes ``df`` by bucket below ``target``; returns the rows written."""
    return append_table(df.withColumn(BUCKET, bucket_of(keys, buckets)), target, partition_by=[BUCKET], mode=mode)


def source_key_stats(source: DataFrame, keys: list[str]) -> tuple[int, int, int]:
    """(rows, largest number of rows sharing one non-NULL key, bytes) in one aggregate job."""
    return _source_stats(source, keys, 1)[:3]


def _source_stats(source: DataFrame, keys: list[str], buckets: int) -> tuple[int, int, int, list[int]]:
    """``source_key_stats``, and the buckets of the rows: at most ``buckets`` + 1 numbers."""
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                        F.sum(row_bytes(source)).alias("_b"))
    row = per_key.agg(F.sum("_n").alias("rows"),
                      F.max(F.when(_all_keys_known(keys), F.col("_n"))).alias("most"),
                      F.sum("_b").alias("bytes"), F.collect_set(bucket_of(keys, buckets)).alias("touched")).first()
    return int(row["rows"] or 0), int(row["most"] or 0), int(row["bytes"] or 0), sorted(row["touched"])


def merge_table(spark: SparkSession, path: str, source: DataFrame, keys: list[str],
                update_columns: list[str] | str = "*", set_on_match: dict | None = None,
                insert_values: dict | None = None, broadcast_bytes: int = BROADCAST_BYTES, buckets: int | None = None) -> str:
    """MERGE ``source`` into the table at ``path`` on ``keys`` and commit a new version.

    * matched rows: ``update_columns`` take the source value ("*" = every non-key
      column), ``set_on_match`` columns take the given Column, others keep the target value;
    * source rows without a match are inserted; ``insert_values`` gives the (typed)
      value of target columns the source lacks, e.g. ``F.lit(None).cast("timestamp")``;
    * target rows without a match are kept; nothing is deleted;
    * NULL keys never match, so NULL-key source rows are inserted again.

    An empty source is a no-op. Duplicate keys in the source are an error (a MERGE
    would update one target row twice). Returns the directory of the new version.

    ``buckets`` is the number of buckets of a new table (default: one for each 128 MB of its first rows, at least
    8). Of an existing table only the buckets of the source's keys are read, once, and written. The source is persisted
    for the duration of the merge (lost blocks are recomputed from lineage); one aggregate over it checks its keys
    and measures its size. Up to ``broadcast_bytes`` it is broadcast and the target is only scanned: which source
    rows met a target row is observed on the write itself, as bitmaps of their numbers, and the rest are added. A larger
    source and the touched buckets are shuffled once, by the hash that makes the buckets.
    """
    state = TableState.of(spark, path)
    schema_of = spark.read.parquet(state.places()[0]) if state.version else source
    # The same key must have the same hash, so it takes the table's type first.
    source = source.withColumns({k: F.col(k).cast(dict(schema_of.dtypes)[k]) for k in keys}).persist()
    try:
        rows, most, size, touched = _source_stats(source, keys, state.buckets or buckets or LEAST_BUCKETS)
        if rows == 0:
            return _version_path(path, state.version) if state.version else ""
        if most > 1:
            raise ValueError(f"merge source has duplicate keys on {keys}")
        target_path, known = _version_path(path, state.version + 1), _all_keys_known(keys)
        if not state.version:
            extra = {c: v for c, v in (insert_values or {}).items() if c not in source.columns}
            new = source.withColumns(extra) if extra else source
            wanted = buckets or max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
            if wanted != (buckets or LEAST_BUCKETS):
                touched = _source_stats(source, keys, wanted)[3]
            buckets, merged, unmet = wanted, None, new
        else:
            buckets = state.buckets
            new = _as_inserts(source, schema_of, insert_values)
            places = state.places([b for b in touched if b != UNKEYED])
            merged, unmet = None, new
            if places:
                target, keyed = spark.read.parquet(*places), source.filter(known)
                if size <= broadcast_bytes and rows <= MOST_BITMAPS * _BITS:
                    merged = _merge_broadcast(target, keyed, rows, keys, update_columns, set_on_match, insert_values, buckets, target_path)
                    unmet = _as_inserts(merged.unmet, schema_of, insert_values).unionByName(new.filter(~known))
                else:
                    frames = merge_frames(target, keyed, keys, update_columns, set_on_match, insert_values, buckets=buckets)
                    # A directory without a log row is the leftover of a failed job: overwrite it.
                    merged = _Merged(_write_buckets(frames, keys, buckets, target_path, "overwrite"))
                    unmet = new.filter(~known) if UNKEYED in touched else None
        written = merged.rows if merged else 0
        if unmet is not None:
            if not merged:  # a task a bucket
                unmet = unmet.filter(known).repartition(buckets, *keys).unionByName(unmet.filter(~known))
            written += _write_buckets(unmet, keys, buckets, target_path, "append" if merged else "overwrite")
        _commit(spark, path, state.version + 1, "merge", written, buckets, touched)
        return target_path
    finally:
        source.unpersist()


def _all_keys_known(keys: list[str], prefix: str = "") -> Column:
    known = None
    for k in keys:
        term = F.col(prefix + k).isNotNull()
        known = term if known is None else known & term
    return known


def _as_inserts(source: DataFrame, target: DataFrame, insert_values: dict | None) -> DataFrame:
    """Source rows in the target's columns and types."""
    values = insert_values or {}
    return source.select(*[(F.col(c) if c in source.columns else values.get(c, F.lit(None))).cast(t).alias(c) for c, t in target.dtypes])


@dataclass(frozen=True)
class _Merged:
    rows: int  # written
    unmet: DataFrame | None = None  # source rows that met no target row


def _merge_broadcast(target: DataFrame, source: DataFrame, rows: int, keys: list[str], update_columns, set_on_match: dict | None,
                     insert_values: dict | None, buckets: int, target_path: str) -> _Merged:
    """Writes the touched buckets in one pass over them, and finds the source rows that met no target row by that pass."""
    # Numbered by their (distinct) keys, so that a row has the same number whenever it is computed.
    marked = source.coalesce(1).sortWithinPartitions(*keys).withColumn("_s_number", F.monotonically_increasing_id())
    merged = merge_frames(target, marked, keys, update_columns, set_on_match, insert_values, broadcast_source=True)
    on_write, number = Observation(), F.col("_s_number")
    maps = [F.bitmap_construct_agg(F.when(F.floor(number / _BITS) == i, F.pmod(number, F.lit(_BITS)))).alias(f"met_{i}")
            for i in range(-(-rows // _BITS))]
    out = merged.observe(on_write, F.count(F.lit(1)).alias("rows"), *maps).drop("_s_number")
    # A directory without a log row is the leftover of a failed job: overwrite it.
    out.withColumn(BUCKET, bucket_of(keys, buckets)).write.mode("overwrite").partitionBy(BUCKET).parquet(target_path)
    met = F.lit(False)
    for i in range(len(maps)):
        at = number - i * _BITS
        byte = F.substring(F.lit(bytes(on_write.get[f"met_{i}"])), F.floor(at / 8).cast("int") + 1, F.lit(1))
        met = met | (at.between(0, _BITS - 1) & (F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(at, F.lit(8)).cast("int")) == 1))
    return _Merged(int(on_write.get["rows"]), marked.filter(~met))


def merge_frames(target: DataFrame, source: DataFrame, keys: list[str],
                 update_columns: list[str] | str = "*", set_on_match: dict | None = None,
                 insert_values: dict | None = None, broadcast_source: bool = False, buckets: int | None = None) -> DataFrame:
    """The merged rows, as a lazy DataFrame.

    Rows with a NULL in any key can never match, so they bypass the join (target
    rows are kept, source rows inserted). A NULL key therefore never becomes one hot join partition.

    ``broadcast_source=False``: one full outer sort-merge join of target and source, after a shuffle of both by the hash of
    the keys (to ``buckets`` partitions, if given: then each task holds one bucket).
    ``broadcast_source=True`` (the caller has measured the source as small): the target is left-joined to the broadcast
    source, scanned once and never shuffled; source rows without a match are left to the caller, and the source's column
    ``_s_number`` says which source row a target row met (NULL: none).
    """
    set_on_match = set_on_match or {}
    known = _all_keys_known(keys)
    tdtypes = dict(target.dtypes)
    t = target.filter(known) if not broadcast_source else target
    s = source.filter(known)
    if buckets and not broadcast_source:
        t, s = t.repartition(buckets, *keys), s.repartition(buckets, *keys)
    t = t.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_t_hit"))
    s = s.select(*[F.col(c).alias(c if c == "_s_number" else f"_s_{c}") for c in source.columns], F.lit(True).alias("_s_hit"))
    cond = None
    for k in keys:
        term = F.col(f"_t_{k}") == F.col(f"_s_{k}")
        cond = term if cond is None else cond & term
    updates = {c for c in source.columns if c not in keys} if update_columns == "*" else set(update_columns)
    values = insert_values or {}
    matched = F.col("_t_hit").isNotNull() & F.col("_s_hit").isNotNull()
    out = []
    for c in target.columns:
        tcol = F.col(f"_t_{c}")
        on_match = set_on_match.get(c, F.col(f"_s_{c}") if c in updates and c in source.columns else tcol)
        expr = F.when(matched, on_match).otherwise(tcol)
        if not broadcast_source:
            inserted = F.col(f"_s_{c}") if c in source.columns else values.get(c, F.lit(None))
            expr = F.when(F.col("_t_hit").isNull(), inserted).otherwise(expr)
        out.append(expr.cast(tdtypes[c]).alias(c))
    if broadcast_source:
        return t.join(F.broadcast(s), cond, "left").select(*out, "_s_number")
    keyed = t.join(s, cond, "full_outer").select(*out)
    if buckets:  # the caller keeps rows without a key apart
        return keyed
    return keyed.unionByName(target.filter(~known)).unionByName(_as_inserts(source.filter(~known), target, insert_values))
