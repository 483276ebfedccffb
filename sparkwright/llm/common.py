"""Shared helpers: tables, the shared scratch folder, and byte-level word splitting for Arrow batches."""

from __future__ import annotations

import gc
import os
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only (``lower`` would also change other alphabets)."""
    return F.translate(text, UPPER, LOWER)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a ``local`` master may go without it (tests); anything else raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile
        folder = "file://" + tempfile.mkdtemp(prefix="sparkwright-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, clean_up: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives lost executors,
    and lets the planner see the real size of the result. With ``clean_up`` Spark deletes the shuffle files of the write as
    soon as it ends, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    before = spark.conf.get(CLEAN_UP, "false")
    try:
        spark.conf.set(CLEAN_UP, str(clean_up or before == "true").lower())
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more, rather than when the driver
    happens to collect its garbage."""
    for _ in range(2):  # the gateway drops its references a little after Python does
        gc.collect()
        time.sleep(0.5)
        spark.sparkContext._jvm.System.gc()


# -- inside tasks ---------------------------------------------------------------------------------

SLICE_BYTES = 4_000_000


def small(batches: Iterator[pa.RecordBatch], most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``most`` bytes, so that what a task makes of one stays small."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, row offsets) of consecutive rows with about ``most`` bytes.

    Null texts count as empty; one longer text makes a slice of its own.
    """
    texts = pc.fill_null(texts, "")
    n = len(texts)
    if not n:
        return
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, off, data = texts.buffers()
    off = np.frombuffer(off, width)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1))
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def lowered(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def word_spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (exclusive) of maximal runs of True that don't cross rows, and each row's first run."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    before[cut[:-1]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    after[cut[1:]] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, off)


def space_words(data: np.ndarray) -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    return ~((data == 32) | ((data >= 9) & (data <= 13)))


def letter_words(data: np.ndarray) -> np.ndarray:
    """Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``: digits, a-z and all beyond ASCII."""
    table = np.zeros(256, bool)
    table[48:58] = table[97:123] = table[128:] = True
    return table[data]


def mixed(h: np.ndarray) -> np.ndarray:
    """A finishing step that spreads 64-bit values (wraps around)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, from one running sum of byte times power."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    base = 0x9E3779B97F4A7C15
    n = len(data)
    power = np.multiply.accumulate(np.full(n, base, np.uint64))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(power * (data.astype(np.uint64) + np.uint64(1)), out=total[1:])
    inverse = np.multiply.accumulate(np.full(n, pow(base, -1, 1 << 64), np.uint64))
    return mixed((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k consecutive words from each position (``len(words) - k + 1`` of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
    return mixed(h)


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its group) of the graph with links a-b, by label passing and pointer jumps."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == root).all():
            return nodes, nodes[root]
        root = new
